"""Personal data by patterns, and terms that give it away by information content.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers, found
by pattern and checked (parts of an address, Luhn, number of digits). Each distinct
value is a protected entity. Terms that stand in a text with an entity reveal it in so
far as they are found with it and not without it: with counts over all whole documents,
the pointwise mutual information of entity and term is compared with the entity's own
information content. A term that carries ``DISCLOSURE`` of it or more in at least
``SUPPORT`` documents is generalised, from ``REMOVAL`` on removed, wherever it stands
in the documents that hold the entity.

Everything is DataFrame functions. Patterns work row by row; entities with the words of
their texts and word counts are exchanged, texts only if the terms found are too many to
be broadcast. As an entity and a term are together in n_entity documents at most, a term
in more than n ** (1 - DISCLOSURE) * n_entity ** DISCLOSURE of n cannot disclose it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.scratch import discard, stored

KINDS = ("email", "ip", "card", "phone", "term")
SUPPORT = 3
DISCLOSURE = 0.9
REMOVAL = 0.98
LEAST_LETTERS = 3
# Words in more than one of so many documents are held against all others in a list, which
# so many times the words of a mean document bound.
FREQUENT = 1000

# Patterns that match what their plain forms match, but never try a place twice: a
# match can only begin where a run of its first characters begins (or the last match
# ended), and runs are not given back.
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Cheap conditions that hold for every text with a match that can be valid.
_MAY_HAVE = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_MENTION = "struct<start:int,end:int,kind:int,value:string>"


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":

        def small(part: Column) -> Column:
            bare = F.ltrim(part, F.lit("0"))
            return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

        return F.forall(F.split(match, r"\."), small)
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    return F.length(digits).between(9, 15)


def _entity(kind: str, match: Column) -> Column:
    """The protected value, however it is written."""
    return F.lower(match) if kind in ("email", "ip") else F.regexp_replace(match, "[^0-9]", "")


def _mentions(kind: str, text: Column) -> Column:
    """Valid matches with offsets in code points, from the lengths of the pieces between."""
    pattern = PATTERNS[kind]
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    numbered = F.transform(matches, lambda m, i: F.struct(m.alias("m"), i.alias("i")))

    def step(state: Column, item: Column) -> Column:
        match = item["m"]
        start = state["at"] + F.length(F.get(pieces_at, item["i"]))
        end = start + F.length(match)
        mention = F.struct(
            start.alias("start"),
            end.alias("end"),
            F.lit(KINDS.index(kind)).alias("kind"),
            _entity(kind, match).alias("value"),
        )
        found = F.when(_valid(kind, match), F.concat(state["found"], F.array(mention))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    # One array of pieces, made once per text: the fold runs inside a transform over it.
    pieces_at = None
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_MENTION}>").alias("found"))

    def fold(cut: Column) -> Column:
        nonlocal pieces_at
        pieces_at = cut
        return F.aggregate(numbered, start, step, lambda s: s["found"])

    folded = F.get(F.transform(F.array(pieces), fold), F.lit(0))
    return F.when(F.coalesce(text.rlike(_MAY_HAVE[kind]), F.lit(False)), folded).otherwise(F.array().cast(f"array<{_MENTION}>"))


_SPACE = r"[\x20\x09-\x0D]"
_EDGES = r"^[^\p{L}]++|[^\p{L}]++$"
_WORD = rf"^\p{{L}}[\p{{L}}'’-]{{{LEAST_LETTERS - 1},}}+$"


def _words(text: Column) -> Column:
    """Distinct words of a text in lower case without punctuation around them; letters only."""
    bare = F.transform(F.split(text, f"{_SPACE}+"), lambda w: F.regexp_replace(w, _EDGES, ""))
    return F.array_distinct(F.transform(F.filter(bare, lambda w: w.rlike(_WORD)), F.lower))


_TERMS = "array<struct<start:int,end:int,kind:int,disclosed:double>>"


def _places(text: Column, disclosed: Column) -> Column:
    """Where the words of the map ``disclosed`` stand in the whole text."""
    parts = F.split(text, _SPACE, -1)

    def step(state: Column, part: Column) -> Column:
        bare = F.regexp_replace(part, _EDGES, "")
        share = F.try_element_at(disclosed, F.lower(bare))
        start = state["at"] + F.length(part) - F.length(F.regexp_replace(part, r"^[^\p{L}]++", ""))
        word = F.struct(start.alias("start"), (start + F.length(bare)).alias("end"), F.lit(KINDS.index("term")).alias("kind"), share.alias("disclosed"))
        found = F.when(share.isNotNull(), F.concat(state["found"], F.array(word))).otherwise(state["found"])
        return F.struct((state["at"] + F.length(part) + 1).alias("at"), found.alias("found"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(_TERMS).alias("found"))
    return F.when(disclosed.isNull(), F.array().cast(_TERMS)).otherwise(F.aggregate(parts, start, step, lambda s: s["found"]))


def _in_order(a: Column, b: Column) -> Column:
    return F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"])


def base_mentions(text: Column) -> Column:
    """All base spans of a text by start and kind."""
    whole = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*[_mentions(kind, whole) for kind in PATTERNS]), _in_order)


def _most_documents(n: int, n_entity: Column | int) -> Column:
    """In how many of ``n`` documents a term can be that discloses an entity in ``n_entity``."""
    return F.lit(float(n)) ** (1 - DISCLOSURE) * F.lit(n_entity).cast("double") ** DISCLOSURE * (1 + 1e-9)


def _disclosing(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``row`` and ``disclosed``, a map of the terms of that row that disclose an entity of
    it, each with the greatest share it carries.

    ``rows`` has ``row``, ``mentions`` and the ``text`` of rows with mentions, ``texts``
    the ``text`` of every row.
    """
    name = lambda m: F.concat_ws(":", m["kind"].cast("string"), m["value"])
    held = rows.filter(F.size("mentions") > 0).withColumn("entities", F.array_distinct(F.transform("mentions", name)))
    owned = held.select("row", F.explode("entities").alias("entity"))
    known = owned.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).filter(F.col("n_entity") >= SUPPORT)
    entities = stored(known, "entities")
    words = texts.select(F.explode(_words(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    terms = stored(words.filter(F.col("n_term") >= SUPPORT), "terms")
    n, most = texts.count(), entities.agg(F.max("n_entity")).first()[0] or 0
    too_many = F.greatest(_most_documents(n, most), F.lit(n / FREQUENT))
    frequent = stored(terms.filter(F.col("n_term") > too_many).select("term"), "frequent-terms")

    # Entities of a row that enough documents hold; both tables are joined by their real sizes.
    known_of = stored(owned.join(entities, "entity").groupBy("row").agg(F.collect_list("entity").alias("known")), "known-entities")
    rare = held.join(known_of, "row").select("row", "known", F.explode(_words(F.col("text"))).alias("term")).join(frequent, "term", "left_anti")
    around = stored(rare.select("row", F.explode("known").alias("entity"), "term"), "entity-words")
    both = around.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both")).filter(F.col("n_both") >= SUPPORT)
    measured = both.join(terms, "term").join(entities, "entity").filter(F.col("n_term") <= _most_documents(n, F.col("n_entity")))
    content = F.log2(F.lit(n) / F.col("n_entity"))
    mutual = F.log2(F.col("n_both") * F.lit(n) / (F.col("n_entity") * F.col("n_term")))
    share = F.when(content > 0, mutual / content).otherwise(F.lit(0.0))
    pairs = stored(measured.select("entity", "term", share.alias("share")).filter(F.col("share") >= DISCLOSURE), "entity-terms")
    shares = around.join(pairs, ["entity", "term"]).groupBy("row", "term").agg(F.max("share").alias("share"))
    found = stored(shares.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("disclosed")), "disclosing")
    for done in (entities, terms, frequent, known_of, around, pairs):
        discard(done)
    return found


def _with_terms(rows: DataFrame, texts: DataFrame, text: Column) -> DataFrame:
    """``rows`` with ``terms``, the spans of disclosing words by start, in their ``text``."""
    marks = _disclosing(rows.select("row", "mentions", text.alias("text")), texts)
    return rows.join(marks, "row", "left").withColumn("terms", _places(text, F.col("disclosed"))).drop("disclosed")


def found(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``doc`` (a struct of all columns of ``docs``), ``mentions`` (base spans) and
    ``terms`` (start, end, kind, disclosed): the spans the method adds.

    Null texts count as empty. Repeated rows and rows with null ids are rows of their
    own. Terms are marked everywhere in the texts that hold the entity they give away, so
    a text without an entity is never changed.
    """
    whole = docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc"), base_mentions(F.col(text_column)).alias("mentions"))
    rows = stored(whole, "mentions")
    text = F.coalesce(F.col("doc")[text_column], F.lit(""))
    return _with_terms(rows, rows.select(text.alias("text")), text).select("doc", "mentions", "terms")


def _written(kind: Column, start: Column, end: Column) -> Column:
    return F.concat_ws(":", kind, start.cast("string"), end.cast("string"))


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts by kind, ``base_sha256`` and ``spans`` for every row; ``n_term`` too."""
    # Of the texts only those with mentions are written again.
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    found = texts.select(F.monotonically_increasing_id().alias("row"), "id", "text", base_mentions(F.col("text")).alias("mentions"))
    rows = stored(found.withColumn("text", F.when(F.size("mentions") > 0, F.col("text"))), "mentions")
    rows = _with_terms(rows, texts.select("text"), F.col("text"))

    def plain(spans: Column) -> Column:
        return F.transform(spans, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["kind"].alias("kind")))

    base = plain(F.col("mentions"))
    every = F.array_sort(F.concat(base, plain(F.col("terms"))), _in_order)
    names = F.array(*[F.lit(k) for k in KINDS])

    def text_of(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: _written(F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def number(kind: int) -> Column:
        return F.size(F.filter("mentions", lambda m: m["kind"] == kind)).cast("long")

    return rows.select(
        F.col("id").alias(id_column),
        *[number(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])],
        F.sha2(text_of(base), 256).alias("base_sha256"),
        text_of(every).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


def sanitise(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in the text: base spans and generalised
    terms by the name of their kind, terms from ``REMOVAL`` on by nothing. Other
    columns are as they were; a text without spans is not touched, null stays null."""
    marked = found(docs, text_column)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def replaced(span: Column, by: Column) -> Column:
        return F.struct(span["start"].alias("start"), span["end"].alias("end"), by.alias("by"))

    base = F.transform("mentions", lambda m: replaced(m, F.get(names, m["kind"])))
    terms = F.transform("terms", lambda t: replaced(t, F.when(t["disclosed"] >= REMOVAL, F.lit("")).otherwise(F.get(names, t["kind"]))))
    spans = F.array_sort(F.concat(base, terms))
    text = F.col("doc")[text_column]

    def step(state: Column, span: Column) -> Column:
        # A span that begins inside the one before it only makes that one longer.
        inside = span["start"] < state["at"]
        piece = F.concat(F.substring(text, state["at"] + 1, span["start"] - state["at"]), span["by"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(inside, state["pieces"]).otherwise(F.concat(state["pieces"], F.array(piece))).alias("pieces"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("pieces"))
    whole = F.aggregate(
        spans, start, step, lambda s: F.concat(F.array_join(s["pieces"], ""), F.substring(text, s["at"] + 1, F.length(text)))
    )
    clean = F.when(F.size(spans) > 0, whole).otherwise(text)
    return marked.select(F.col("doc").withField(f"`{text_column}`", clean).alias("doc")).select("doc.*")
