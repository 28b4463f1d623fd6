"""Removal of repeated byte strings by suffix order, refined only where it matters.

Every byte position is a suffix. What has to be known of suffix order is which
suffixes agree on their first ``length`` bytes and which position of each such class
comes first: a position whose longest previous factor reaches ``length`` has a
smaller position in its class, and the class's smallest one has only later matches.
So the order is refined bucket by bucket, as in a radix sort, to that depth, and
buckets with a single suffix are never refined at all. Buckets stand in the order of
a hash of their bytes, members of a class by position; which of the previous and next
smaller positions agrees on ``length`` bytes is read off the neighbours.

Suffixes enter the sort in runs. A string of ``length`` bytes holds a position picked
by its content alone: where the hash of the next ``GRAM`` bytes is least. Suffixes
that pick the same position form one run, and runs are bucketed by the bytes there.
Runs of a bucket with equal bytes around them repeat in all their suffixes, and the
earliest of them gives the earlier matches. Where a bucket holds different
surroundings, one run of each is split into shorter runs, and those into single
suffixes. At each step two independent 64-bit hashes stand for the bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanwatch.llm.scratch import discard, release, stored

LENGTH = 200
GRAM = 64
STEP = 16
SEGMENT = 1 << 18
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_NODE = "row bigint, at bigint, lo int, hi int, k bigint, u bigint"
_ORDERED = ["part", "row", "at", "lo", "hi", "k", "u", "same", "differ", "first_row", "first_at"]
_ORDER = f"part bigint, {_NODE}, same boolean, differ boolean, first_row bigint, first_at bigint"


class Hasher:
    """Hashes of byte ranges from sums of powers, modulo 2 to the 64."""

    def __init__(self, which: int, size: int) -> None:
        base = _BASES[which]
        self.values = np.random.default_rng(1000 + which).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = self._powers(base, size)
        self.inverses = self._powers(pow(base, -1, 1 << 64), size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        factors = np.full(size + 1, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.inverses[start])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def least_of_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the first least value of every window of ``width``."""
    best, size, n = np.arange(len(values)), 1, len(values)
    while size < width:
        step = min(size, width - size)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        size += step
    return best[: n - width + 1]


def runs(data: np.ndarray, hashers: tuple[Hasher, Hasher], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of suffixes of one segment: picked position, least and greatest distance
    of their starts to it, hash of the bytes there and hash of all bytes around."""
    first, second = hashers
    sums = first.sums(data)
    grams = first.ranges(sums, np.arange(len(data) - gram + 1), np.arange(gram, len(data) + 1))
    picked = least_of_windows(grams, length - gram + 1)
    cut = np.flatnonzero(np.diff(picked)) + 1
    s1, s2 = np.concatenate(([0], cut)), np.concatenate((cut, [len(picked)])) - 1
    at = picked[s1]
    lo, hi = at - s2, at - s1
    around = second.ranges(second.sums(data), s1, s2 + length)
    shape = (lo * 1024 + hi).astype(np.uint64)
    return at, lo, hi, grams[at], mixed(around + shape * np.uint64(_BASES[0]))


def _segments(text: str | None, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """The whole text in pieces that hold each start of ``length`` bytes once."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    for start in range(0, max(0, len(data) - length + 1), SEGMENT):
        yield start, data[start : start + SEGMENT + length - 1]


def _batch(parts: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
    kinds = [np.int64, np.int64, np.int32, np.int32]
    arrays = [pa.array(c.astype(k)) for c, k in zip(columns, kinds, strict=False)]
    return pa.RecordBatch.from_arrays([*arrays, *(pa.array(c.view(np.int64)) for c in columns[4:])], names)


def _first_runs(texts: DataFrame, length: int, gram: int) -> DataFrame:
    names = ["row", "at", "lo", "hi", "k", "u"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = Hasher(0, SEGMENT + length), Hasher(1, SEGMENT + length)
        for batch in batches:
            parts, held = [], 0
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for start, data in _segments(text.as_py(), length):
                    at, lo, hi, k, u = runs(data, hashers, length, gram)
                    parts.append((np.full(len(at), row), at + start, lo, hi, k, u))
                    held += len(at)
                    if held > 1 << 17:
                        yield _batch(parts, names)
                        parts, held = [], 0
            if parts:
                yield _batch(parts, names)

    return texts.select("row", "text").mapInArrow(run, _NODE)


def _neighbours(part: int, row: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: np.ndarray, u: np.ndarray) -> pa.RecordBatch:
    """Whole buckets in suffix order, decided by the neighbours in that order.

    Runs of a class (equal ``k`` and ``u``) stand by ascending position, so the previous
    smaller position of a run is its neighbour before, and only the class's first run has
    none that agrees with it: its longest previous factor is too short. ``part`` names
    the range of a bucket that other ranges may share (-1: none does).
    """
    opens = np.concatenate(([True], k[1:] != k[:-1]))
    has_none = opens | np.concatenate(([True], u[1:] != u[:-1]))
    of_class, of_bucket = np.cumsum(has_none) - 1, np.cumsum(opens) - 1
    firsts = np.flatnonzero(has_none)
    same = np.bincount(of_class)[of_class] > 1
    differ = np.bincount(of_bucket[firsts])[of_bucket] > 1
    live = np.flatnonzero(same | differ | (part >= 0))
    first = firsts[of_class[live]]
    columns = [np.full(len(live), part), *(c[live] for c in (row, at, lo, hi, k, u, same, differ)), row[first], at[first]]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns)], _ORDERED)


def _in_order(batches: Iterator[pa.RecordBatch], part: int | None = None) -> Iterator[pa.RecordBatch]:
    """One range of the suffix order, as it comes, bucket by bucket. Its first and last
    bucket may go on in the ranges beside it and are decided for this range only."""
    part = TaskContext.get().partitionId() if part is None else part
    edge, waiting = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy() for c in batch.columns]
        k = columns[4]
        edge = k[0] if edge is None else edge
        others = np.flatnonzero(k != k[-1])
        cut = others[-1] + 1 if len(others) else 0
        if waiting and (cut or waiting[0][4][0] != k[-1]):
            columns = [np.concatenate(c) for c in zip(*waiting, columns, strict=True)]
            cut += len(columns[0]) - len(k)
            waiting = []
        whole, rest = [c[:cut] for c in columns], [c[cut:] for c in columns]
        begin = int(np.searchsorted(whole[4] != edge, True))
        if begin:
            yield _neighbours(part, *(c[:begin] for c in whole))
        if begin < cut:
            yield _neighbours(-1, *(c[begin:] for c in whole))
        waiting.append(rest)
    if waiting:
        yield _neighbours(part, *(np.concatenate(c) for c in zip(*waiting, strict=True)))


def _borders(order: DataFrame) -> DataFrame:
    """What every range has to know of its parts of buckets that others share: at most
    two short rows a range, however large a bucket is.

    ``before`` is the first run of the part's first class (``head``), if that lies in an
    earlier range; ``after`` says that its last class (``tail``) goes on; ``others``
    that the bucket holds several classes.
    """
    parts = order.filter("part >= 0").groupBy("part", "k").agg(
        F.min(F.struct("u", "row", "at")).alias("start"), F.max("u").alias("tail"), F.max_by(F.struct("first_row", "first_at"), "u").alias("first")
    )
    every = Window.partitionBy("k")
    along = every.orderBy("start")
    goes_on = F.coalesce(F.lag("tail").over(along) == F.col("start.u"), F.lit(False))
    parts = parts.withColumn("goes_on", goes_on).withColumn("own", F.when(~F.col("goes_on") | (F.col("start.u") != F.col("tail")), F.col("first")))
    carried = F.last("own", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    return parts.select(
        "part",
        "k",
        F.col("start.u").alias("head"),
        "tail",
        F.when(F.col("goes_on"), carried).alias("before"),
        F.coalesce(F.lead("start.u").over(along) == F.col("tail"), F.lit(False)).alias("after"),
        (F.min("start.u").over(every) != F.max("tail").over(every)).alias("others"),
    )


def _stitched(order: DataFrame, borders: DataFrame) -> DataFrame:
    """Decisions of all ranges, with those for the buckets at their borders completed."""
    joined = order.join(F.broadcast(borders), ["part", "k"], "left")
    of_head = F.coalesce(F.col("before").isNotNull() & (F.col("u") == F.col("head")), F.lit(False))
    of_tail = F.coalesce(F.col("after") & (F.col("u") == F.col("tail")), F.lit(False))
    places = [F.when(of_head, F.col(f"before.{c}")).otherwise(F.col(c)).alias(c) for c in ("first_row", "first_at")]
    same, differ = F.col("same") | of_head | of_tail, F.col("differ") | F.coalesce("others", F.lit(False))
    return joined.select("row", "at", "lo", "hi", same.alias("same"), differ.alias("differ"), *places).filter("same or differ")


def _ordered(nodes: DataFrame, name: str) -> DataFrame:
    """Nodes whose bucket (``k``) holds others, with what the order around them shows.

    ``same``: other runs of the bucket have equal bytes, the earliest of which is at
    (``first_row``, ``first_at``). ``split``: the bucket also holds different bytes, so
    the run, of equal ones the earliest only, has to be met by them in shorter pieces.

    The nodes are computed once and written, then sorted by ranges of bucket, class and
    position, so buckets and classes of any size are spread over the tasks.
    """
    table = stored(nodes, name)
    keys = ["k", "u", "row", "at"]
    order = stored(table.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_in_order, _ORDER), f"{name}-order")
    discard(table)
    release(nodes.sparkSession)
    every = _stitched(order, stored(_borders(order), f"{name}-borders"))
    is_first = (F.col("row") == F.col("first_row")) & (F.col("at") == F.col("first_at"))
    return every.select("row", "at", "lo", "hi", "same", (F.col("differ") & is_first).alias("split"), "first_row", "first_at")


def _surroundings(texts: DataFrame, nodes: DataFrame, length: int) -> DataFrame:
    """``bytes`` around the runs of ``nodes``: from the first suffix's start to the
    last one's end."""
    by_row = nodes.groupBy("row").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("runs"))
    joined = texts.select("row", "text").join(by_row, "row").select("row", "text", "runs.at", "runs.lo", "runs.hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                data = batch.column(1)[k].as_py().encode("utf-8", "surrogatepass")
                at, lo, hi = (np.asarray(batch.column(c)[k].values) for c in (2, 3, 4))
                cuts = [data[s:e] for s, e in zip((at - hi).tolist(), (at - lo + length).tolist(), strict=True)]
                row = pa.array(np.full(len(at), batch.column(0)[k].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([row, pa.array(at), pa.array(lo), pa.array(hi), pa.array(cuts, pa.binary())], ["row", "at", "lo", "hi", "bytes"])

    return joined.mapInArrow(run, "row bigint, at bigint, lo int, hi int, bytes binary")


def _split(around: DataFrame, length: int, step: int) -> DataFrame:
    """Runs cut at distances that are multiples of ``step``; at step 1, the suffixes.

    ``k`` stands for the bytes that all suffixes of an uncut piece share, ``u`` for all
    bytes around the piece as it is.
    """
    names = ["row", "at", "lo", "hi", "k", "u"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = Hasher(0, SEGMENT + 4 * length), Hasher(1, SEGMENT + 4 * length)
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in range(4)]
            held = batch.column(4).to_pylist()
            sizes = np.fromiter(map(len, held), np.int64, len(held))
            group = np.cumsum(sizes) // SEGMENT
            for g in np.unique(group):
                chosen = np.flatnonzero(group == g)
                row, at, lo, hi = (c[chosen] for c in columns)
                data = np.frombuffer(b"".join(held[k] for k in chosen.tolist()), np.uint8)
                begins = np.cumsum(sizes[chosen]) - sizes[chosen]
                # The pieces of each run, all runs one after the other.
                many = hi // step - lo // step + 1
                of = np.repeat(np.arange(len(chosen)), many)
                piece = (lo // step)[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
                low, high = np.maximum(lo[of], piece * step), np.minimum(hi[of], piece * step + step - 1)
                zero = begins[of] + hi[of]
                first, second = (h.sums(data) for h in hashers)
                core = hashers[0].ranges(first, zero - piece * step, zero - piece * step - step + 1 + length)
                union = hashers[1].ranges(second, zero - high, zero - low + length)
                k = mixed(core + piece.astype(np.uint64) * np.uint64(_BASES[1]))
                u = mixed(union + (low * 1024 + high).astype(np.uint64) * np.uint64(_BASES[0]))
                yield _batch([(row[of], at[of], low, high, k, u)], names)

    return around.mapInArrow(run, _NODE)


def repeats(texts: DataFrame, length: int = LENGTH, gram: int | None = None) -> DataFrame:
    """Runs of repeated suffixes: row, ``start`` and ``end`` of the bytes they cover,
    and ``earlier``: whether each of them also starts at a smaller (row, position),
    that is, has a longest previous factor of ``length`` or more.

    ``texts`` has ``row`` (a long that tells rows apart) and ``text``, and must be read
    in the same way each time, as a table is. A string that only overlaps itself
    elsewhere counts as repeated. Null texts are empty.
    """
    spark = texts.sparkSession
    gram = min(GRAM, length) if gram is None else gram
    found = _ordered(_first_runs(texts, length, gram), "runs")
    done = [found.filter("same")]
    release(spark)
    around = stored(_surroundings(texts, found.filter("split"), length), "surroundings")
    release(spark)
    pieces = _ordered(_split(around, length, STEP), "pieces")
    done.append(pieces.filter("same"))
    release(spark)
    # Pieces lie inside the run they were cut from; they are cut out of its bytes.
    cut = pieces.filter("split").select("row", F.col("at").alias("at2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    inside = around.alias("a").join(
        cut.alias("c"), (F.col("a.row") == F.col("c.row")) & (F.col("a.at") == F.col("c.at2")) & F.col("c.lo2").between(F.col("a.lo"), F.col("a.hi"))
    )
    bytes_of = F.substring(F.col("bytes"), F.col("a.hi") - F.col("hi2") + 1, F.col("hi2") - F.col("lo2") + length)
    smaller = inside.select(F.col("a.row").alias("row"), "at", F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), bytes_of.alias("bytes"))
    suffixes = _ordered(_split(smaller, length, 1), "suffixes")
    discard(around)
    release(spark)
    done.append(suffixes.filter("same"))
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    is_first = (F.col("row") == F.col("first_row")) & (F.col("at") == F.col("first_at"))
    return every.select("row", (F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + length).alias("end"), (~is_first).alias("earlier"))


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    order = np.argsort(starts, kind="stable")
    spans: list[list[int]] = []
    for s, e in zip(starts[order].tolist(), ends[order].tolist(), strict=True):
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([s, e])
    return [(s, e) for s, e in spans]


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "none", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256``, ``kept`` (the remaining bytes) and ``spans`` (removed runs).

    ``keep="none"`` removes every byte under a string of ``length`` bytes that also
    starts elsewhere; ``keep="first"`` leaves the earliest copy of each, in the order
    of the rows. Null texts are empty, repeated rows are copies of each other, null
    ids keep their rows. ``docs`` is read several times and has to come in the same
    order each time, as a stored table does.
    """
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).withColumn("row", F.monotonically_increasing_id())
    runs_found = repeats(texts, length)
    if keep == "first":
        runs_found = runs_found.filter("earlier")
    by_row = runs_found.groupBy("row").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    joined = texts.join(by_row, "row", "left").select("id", "text", "starts", "ends")
    spans_kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                data = (batch.column(1)[k].as_py() or "").encode("utf-8", "surrogatepass")
                spans = []
                if batch.column(2)[k].is_valid:
                    spans = _merged(*(np.asarray(batch.column(c)[k].values) for c in (2, 3)))
                kept, last = [], 0
                for s, e in spans:
                    kept.append(data[last:s])
                    last = e
                rest = b"".join([*kept, data[last:]])
                out.append((len(data), len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), rest, [{"start": s, "end": e} for s, e in spans]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), spans_kind]
            columns = [pa.array([o[c] for o in out], kind) for c, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    kind = texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, spans array<struct<start:bigint,end:bigint>>"
    return joined.mapInArrow(run, schema).withColumnRenamed("id", id_column)
