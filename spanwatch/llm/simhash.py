"""SimHash fingerprints and pigeonring candidate filtering (near duplicates of texts).

A fingerprint is the bitwise majority of the hashes of a text's word shingles. Two
texts are linked when their fingerprints differ in at most ``MAX_BITS`` bits.

The 64 bits are cut into a ring of five segments. If two fingerprints differ in at
most t bits, some segment starts a chain in which the first j segments together
differ in at most j * t / 5 bits, for every j up to 5 (pigeonring principle; the
plain pigeonhole only says so for j = 1). With t = 4 the budgets are 0, 1, 2, 3
and 4. The first two steps of the chain become a join key: the first segment is
equal and the second differs in at most one bit, so each fingerprint is filed under
its own 26 bits and looked up under those and their one-bit changes. The rest of the
chain prunes the candidates before the full distance is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.components import connected
from spanwatch.llm.scratch import stored

SEED = 42
SHINGLE = 4
MAX_BITS = 4
WIDTHS = (13, 13, 13, 13, 12)
_SLICE = 1 << 16


def words(text: str) -> list[bytes]:
    """Words of a text between white space, with A to Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> Iterator[np.ndarray]:
    """Hashes of all shingles, in order, some at a time; a text shorter than one shingle
    counts as one shingle of all its words, one without words has none."""
    parts = words(text or "")
    if not parts:
        return
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(parts))
    last = len(parts) - size + 1
    digest = xxhash.xxh64_intdigest
    for low in range(0, last, _SLICE):
        high = min(last, low + _SLICE)
        spans = zip(starts[low:high].tolist(), ends[low + size - 1 : high + size - 1].tolist(), strict=True)
        yield np.fromiter((digest(joined[s:e], seed) for s, e in spans), np.uint64, high - low)


def majority(slices: Iterator[np.ndarray]) -> int:
    """Bits that are set in more than half of the hashes; 0 for none."""
    votes, total = np.zeros(64, np.int64), 0
    for hashes in slices:
        total += len(hashes)
        for bit in range(64):
            votes[bit] += int(np.count_nonzero(hashes & (np.uint64(1) << np.uint64(bit))))
    return int(sum(1 << bit for bit in np.flatnonzero(2 * votes > total).tolist()))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of the shingle hashes as an unsigned 64-bit number; 0 without words."""
    return majority(shingle_hashes(text, shingle, seed))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``id_column`` and ``fp``, the fingerprint as a signed long, one row per input row.

    Null texts count as empty; null and repeated ids keep their rows.
    """
    kept = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)]
            signed = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed, pa.int64())], ["id", "fp"])

    kind = kept.schema["id"].dataType.simpleString()
    return kept.mapInArrow(run, f"id {kind}, fp bigint")


def _offsets() -> list[int]:
    return [sum(WIDTHS[:i]) for i in range(len(WIDTHS))]


def _rotated(fp: Column, start: int) -> Column:
    """The ring turned so that segment ``start`` has the lowest bits."""
    by = _offsets()[start]
    if not by:
        return fp
    return F.shiftrightunsigned(fp, by).bitwiseOR(F.shiftleft(fp, 64 - by))


def _chain_mask(start: int, length: int) -> int:
    mask, offsets = 0, _offsets()
    for step in range(length):
        segment = (start + step) % len(WIDTHS)
        mask |= ((1 << WIDTHS[segment]) - 1) << offsets[segment]
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _own_key(start: int) -> Column:
    """Segments ``start`` and the next, with the number of the start in the top bits."""
    bits = WIDTHS[start] + WIDTHS[(start + 1) % len(WIDTHS)]
    return _rotated(F.col("fp"), start).bitwiseAND(F.lit((1 << bits) - 1)).bitwiseOR(F.lit(start << 32))


def _filed(classes: DataFrame) -> DataFrame:
    starts = F.array(*[F.struct(F.lit(i).alias("start"), _own_key(i).alias("key")) for i in range(len(WIDTHS))])
    return classes.select("*", F.explode(starts).alias("s")).select(*classes.columns, "s.start", "s.key")


def _looked_up(filed: DataFrame) -> DataFrame:
    """Own keys and those with one bit of the second segment changed."""
    flips = {}
    for start in range(len(WIDTHS)):
        second = WIDTHS[(start + 1) % len(WIDTHS)]
        flips[start] = F.array(F.lit(0).cast("long"), *[F.lit(1 << (WIDTHS[start] + bit)).cast("long") for bit in range(second)])
    choice = F.coalesce(*[F.when(F.col("start") == i, flips[i]) for i in flips])
    changed = filed.select(F.col("fp").alias("other"), F.col("part").alias("other_part"), "key", F.explode(choice).alias("flip"))
    return changed.select("other", "other_part", F.col("key").bitwiseXOR(F.col("flip")).alias("key"))


def _stars(filed: DataFrame) -> DataFrame:
    """Links to a few centres of every key: linear in the filed rows."""
    centres = filed.groupBy("key").agg(F.max_by("fp", F.struct("n", "fp")).alias("c0"), F.min("fp").alias("c1"), F.max("fp").alias("c2"), F.count(F.lit(1)).alias("filed"))
    # Spark sizes filed rows by their table before the explode, so it is told not to broadcast.
    joined = filed.hint("merge").join(centres.filter("filed > 1"), "key")
    pairs = joined.select("fp", F.explode(F.array_distinct(F.array("c0", "c1", "c2"))).alias("centre"))
    near = (F.col("fp") != F.col("centre")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("centre"))) <= MAX_BITS)
    return pairs.filter(near).select(F.col("fp").alias("a"), F.col("centre").alias("b"))


def links(classes: DataFrame) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within ``MAX_BITS`` bits.

    ``classes`` has one row per distinct ``fp`` and its number of texts ``n``. Each
    key first links its members to a few centres. Then every pair of the chain join
    is compared, but a link is only put out if the centres did not join its two ends
    already: a dense group of many near copies costs comparisons, not rows.
    """
    filed = _filed(classes)
    stars = stored(_stars(filed).distinct(), "stars")
    joined = stored(connected(stars), "star-groups")
    grouped = stored(
        classes.join(joined, F.col("fp") == F.col("node"), "left").select("fp", "n", F.coalesce("component", "fp").alias("part")), "classes"
    )
    own = _filed(grouped.select("fp", "part"))
    other = _looked_up(own)
    differ = F.col("fp").bitwiseXOR(F.col("other"))
    chain = F.lit(False)
    for start in range(len(WIDTHS)):
        within = F.bit_count(differ.bitwiseAND(F.lit(_chain_mask(start, 3)))) <= 2
        within &= F.bit_count(differ.bitwiseAND(F.lit(_chain_mask(start, 4)))) <= 3
        chain |= (F.col("start") == start) & within
    near = (F.col("part") != F.col("other_part")) & chain & (F.bit_count(differ) <= MAX_BITS)
    # Looked-up rows are some seventy times those Spark sizes them by: never broadcast.
    rest = own.hint("merge").join(other.hint("merge"), "key").filter(near & (F.col("fp") < F.col("other"))).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    return stars.unionByName(rest)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per input row: id, ``fp`` (signed long) and ``component_id``.

    ``component_id`` is the smallest id among the texts that can be reached over
    links. Texts without words have fingerprint 0 and are linked like any other.
    Rows with a null id take part; a component of such rows only has a null id.
    """
    rows = stored(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), "fingerprint-classes")
    groups = stored(connected(links(classes.select("fp", "n"))), "fingerprint-groups")
    named = classes.join(groups, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("component", "fp").alias("part"))
    least = named.groupBy("part").agg(F.min("first").alias("component_id"))
    by_fp = named.join(least, "part").select("fp", "component_id")
    # One row per text on one side, one per fingerprint on the other: both grow with the input.
    return rows.hint("merge").join(by_fp, "fp").select(F.col("id").alias(id_column), "fp", "component_id")


def drop_copies(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of every group of :func:`near_duplicates`: the one with the
    smallest doc_id, of repeated rows any one. Columns are as they were; null ids sort
    first, and texts without words are copies of each other. An empty table stays empty.

    ``docs`` is read twice and has to come in the same order, as a stored table does.
    """
    placed = docs.select(F.struct("doc_id", F.monotonically_increasing_id().alias("row")).alias("key"), F.struct("*").alias("doc"))
    found = near_duplicates(placed.select("key", "doc.text"), "key", "text", shingle)
    # Those that go are the fewer, so they are what the documents are held against.
    gone = stored(found.filter(F.col("key") != F.col("component_id")).select("key.row"), "dropped-rows")
    return placed.withColumn("row", F.col("key.row")).join(gone, "row", "left_anti").select("doc.*")
