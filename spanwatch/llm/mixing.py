"""Mixing sources to target weights by pivotal dependent rounding.

Every text of a source gets the same fractional number of copies, target over size
of the source. Its whole part is taken at once. The fractions are rounded in pairs:
words of one text's fraction are moved to the other's, in a random direction whose
odds keep both expectations, until one of the two is integral; the other goes on to
the next pair. So the words expected from a source stay the same to the end, and
only the one text left last is rounded on its own.

Pairs are met in a reduction tree. The texts of a source are dealt round robin, in
order of size, into blocks of at most ``BLOCK``; each block is folded from its
largest text to its smallest and leaves one residual; the residuals form the blocks
of the next level. A source of any size is spread over all tasks. Everything is
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.numbering import numbered
from spanwatch.llm.scratch import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
BLOCK = 128
SEED = 20240229
_TINY = 1e-9


def sizes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """``id``, ``source`` and ``size``, the number of words (0 for a null text)."""
    count = F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_column).alias("id"), F.col(source_column).alias("source"), count.alias("size"))


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source``, ``place``, ``source_size`` and ``target`` of every source.

    ``totals`` has source and source_size, one row each. Sources in order of their
    code points (null last) weigh ``weights``, repeating, and share ``share`` times
    all sizes. A target stops at ``most`` times its source; what is above is shared
    again by weight among the others, until none is above. Each round is one
    aggregate of the sources; the driver holds three numbers.
    """
    # Bytes of UTF-8 sort as code points do.
    keyed = totals.withColumn("_null", F.col("source").isNull()).withColumn("_key", F.coalesce(F.encode("source", "UTF-8"), F.lit(b"")))
    ranked = numbered(keyed, ["_null", "_key"], "place").drop("_null", "_key")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = stored(ranked.withColumn("_w", weight), "sources")
    cap = F.lit(most) * F.col("source_size")
    whole = weighed.agg(F.sum("source_size")).first()[0] or 0
    per_weight, held = 0.0, -1
    while True:
        stopped = cap <= F.lit(per_weight) * F.col("_w")
        got = weighed.agg(F.count_if(stopped), F.sum(F.when(stopped, cap)), F.sum(F.when(~stopped, F.col("_w")))).first()
        if got[0] == held or got[2] is None:
            break
        held = got[0]
        per_weight = max(per_weight, (share * whole - (got[1] or 0.0)) / got[2])
    return weighed.withColumn("target", F.least(cap, F.lit(per_weight) * F.col("_w"))).drop("_w")


def _uniform(*parts: Column) -> Column:
    """A draw in [0, 1) that is the same on every run."""
    return (F.xxhash64(*parts).bitwiseAND(F.lit((1 << 52) - 1))).cast("double") / F.lit(float(1 << 52))


def _item(row: Column, size: Column, part: Column) -> Column:
    return F.struct(row.cast("long").alias("row"), size.cast("double").alias("size"), part.cast("double").alias("part"))


def _meet(state: Column, item: Column) -> Column:
    """One pair: the carried text and the next one; one of them becomes integral."""
    a, b = state["open"], item
    # Words that can move from b to a, and from a to b, before one is 0 or 1.
    up = F.least((1 - a["part"]) * a["size"], b["part"] * b["size"])
    down = F.least(a["part"] * a["size"], (1 - b["part"]) * b["size"])
    total = up + down
    move = F.when(total <= 0, F.lit(0.0)).when(item["draw"] * total < down, up).otherwise(-down)
    moved_a = F.when(a["size"] > 0, a["part"] + move / a["size"]).otherwise(F.lit(0.0))
    moved_b = F.when(b["size"] > 0, b["part"] - move / b["size"]).otherwise(F.lit(0.0))
    ends_a = (F.abs(moved_a) <= _TINY) | (F.abs(moved_a - 1) <= _TINY)
    rounded_a = F.struct(a["row"].alias("row"), F.round(moved_a).cast("long").alias("extra"))
    rounded_b = F.struct(b["row"].alias("row"), F.round(moved_b).cast("long").alias("extra"))
    return F.struct(
        F.when(ends_a, _item(b["row"], b["size"], moved_b)).otherwise(_item(a["row"], a["size"], moved_a)).alias("open"),
        F.concat(state["done"], F.array(F.when(ends_a, rounded_a).otherwise(rounded_b))).alias("done"),
    )


def _level(items: DataFrame, level: int, block: int) -> DataFrame:
    """Fold every block; one row each with its ``open`` residual and ``done`` texts."""
    counts = items.groupBy("place").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"), F.min("at").alias("first"))
    dealt = items.join(counts, "place").withColumn("block", (F.col("at") - F.col("first")) % F.col("blocks"))
    draw = _uniform(F.lit(SEED), F.lit(level), F.col("place"), F.col("row"))
    entry = F.struct((-F.col("size")).alias("order"), "row", "size", "part", draw.alias("draw"))
    lists = dealt.groupBy("place", "block").agg(F.array_sort(F.collect_list(entry)).alias("items"))
    head = F.element_at("items", 1)
    start = F.struct(
        _item(head["row"], head["size"], head["part"]).alias("open"),
        F.array().cast("array<struct<row:bigint,extra:bigint>>").alias("done"),
    )
    folded = F.aggregate(F.slice("items", 2, block), start, _meet)
    return lists.select("place", "block", folded.alias("state")).select("place", "block", "state.open", "state.done")


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", block: int = BLOCK) -> DataFrame:
    """One row per text: ``id_column``, ``size``, ``source_size``, ``target``,
    ``copies`` (0, 1 or 2) and ``taken`` (copies times size); also ``source``.

    Null ids, null sources (a source of their own), null and empty texts (size 0,
    never taken) and repeated rows keep their rows. A source without words has a
    target of 0. The same input gives the same result.
    """
    base = sizes(docs, id_column, text_column, source_column)
    rows = stored(base, "sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = stored(targets(totals), "targets")
    # One row per source; equal-null join keeps the null source.
    joined = rows.alias("r").join(goal.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source"))).select("r.id", "r.source", "r.size", "g.place", "g.source_size", "g.target")
    mixed_id = F.xxhash64(F.lit(SEED), F.col("id"))
    ready = joined.withColumn("_smaller", -F.col("size")).withColumn("_mixed", mixed_id)
    ordered = numbered(ready, ["place", "_smaller", "_mixed", "id"], "row").drop("_smaller", "_mixed")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.least(copies, F.lit(MOST))
    parted = stored(ordered.withColumn("whole", F.floor(copies + _TINY)).withColumn("part", F.greatest(copies - F.floor(copies + _TINY), F.lit(0.0))), "fractions")

    items = parted.filter((F.col("part") > _TINY) & (F.col("size") > 0)).select("place", "row", F.col("size").cast("double").alias("size"), "part", F.col("row").alias("at"))
    decided = []
    level = 0
    largest = _largest(items)
    while largest > 0:
        folded = stored(_level(items, level, block), f"level{level}")
        decided.append(folded.select(F.explode("done").alias("d")).select("d.row", "d.extra"))
        left = folded.select("place", "open.row", "open.size", "open.part", F.col("block").alias("at"))
        if largest == 1 or largest <= block:
            # The last text of each source goes to the nearer whole number.
            decided.append(left.select("row", F.round("part").cast("long").alias("extra")))
            break
        items, level = left, level + 1
        largest = -(-largest // block)
    if decided:
        extra = decided[0]
        for more in decided[1:]:
            extra = extra.unionByName(more)
    else:
        extra = parted.select("row", F.lit(0).cast("long").alias("extra")).limit(0)
    # Spark sizes the texts of the blocks by the blocks' table, so it is told not to broadcast them.
    taken = parted.join(extra.hint("merge"), "row", "left").withColumn("copies", (F.col("whole") + F.coalesce("extra", F.lit(0))).cast("long"))
    return taken.select(
        F.col("id").alias(id_column), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", F.col("source").alias(source_column)
    )


def _largest(items: DataFrame) -> int:
    return items.groupBy("place").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def take(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, all columns as they were, and behind
    them ``mix_size``, ``mix_target``, ``mix_copies`` and ``mix_taken`` as :func:`mix`
    names them without the prefix; columns of ``docs`` that begin with mix_ are left
    out. ``docs`` is read twice, as a table is."""
    placed = docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc"))
    mixed = mix(placed.select("row", "doc.text", "doc.source"), "row").filter("copies > 0")
    columns = [F.col(c).alias(f"mix_{c}") for c in ("size", "target", "copies", "taken")]
    given = [F.col("doc")[c].alias(c) for c in docs.columns if not c.startswith("mix_")]
    return placed.join(mixed.select("row", *columns), "row").select(*given, *[F.col(f"mix_{c}") for c in ("size", "target", "copies", "taken")])
