"""The operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.llm import decontaminate, hnsw, htmltext, mixing, neighbours, passages, quality, runs, sanitise, simhash, suffixes, toxicity, trie

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def llm_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op2_shared_passages(spark, sf_dir):
    return passages.shared_passages(read(spark, sf_dir, "documents"))


@query
def op3_mix_sources(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"))


@query
def op4_repeated_bytes(spark, sf_dir):
    found = suffixes.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op5_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op6_quality(spark, sf_dir):
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op7_html_text(spark, sf_dir):
    return htmltext.extract(read(spark, sf_dir, "pages"))


@query
def op8_personal_data(spark, sf_dir):
    return sanitise.report(read(spark, sf_dir, "documents"))


@query
def op9_near_vectors(spark, sf_dir):
    return neighbours.link(read(spark, sf_dir, "embeddings"))


@query
def op10_simhash(spark, sf_dir):
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op11_nearest_vectors(spark, sf_dir):
    return hnsw.nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op12_prefix_trie(spark, sf_dir):
    turns, convs = trie.share_openings(trie.ordered_turns(read(spark, sf_dir, "conversations")), every=5, modulus=9)
    return trie.prefix_trie(turns, convs)


def _with_periods(docs: DataFrame) -> DataFrame:
    """Every tenth text, by the crc32 of its id, goes on in a period from some word on."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    g, n = F.floor(F.col("h") / 10), F.size("words").cast("long")
    picked = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    picked = picked.withColumns({"a": F.when(n > 0, g % n), "p": F.when(n > 0, 1 + F.floor((n - g % n) / (3 + g % 8)))})
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    index = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), place)
    moved = F.array_join(F.transform(index, lambda i: F.get("words", i.cast("int"))), " ")
    return picked.select("doc_id", F.when(n > 0, moved).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark, sf_dir):
    found = runs.periodic_runs(_with_periods(read(spark, sf_dir, "documents")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    found = found.withColumn("top", longest)
    length = -F.col("top.less")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        length.alias("length"),
        F.col("top.period").alias("period"),
        F.floor(1000 * length / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
