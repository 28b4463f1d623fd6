"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are compared as sequences of words. Runs of
``LEAST`` words they share are the seeds, found by Karp-Rabin hashes of word numbers.
Where there is a seed, the two are tiled: the longest runs of words that are equal
and not yet marked are marked first, without overlap, until no run of ``LEAST`` words
is left. The share of the item's words under tiles is its coverage; order plays no
part in it, so an item whose sentences were moved about is found as well.

The benchmark is a stated query set: it is held in blocks of bounded size, and each
block meets all documents in one pass that shuffles nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from spanwatch.llm.scratch import stored

LEAST = 5
COVERAGE = 0.8
BLOCK_BYTES = 4 << 20
_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def rolled(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``length`` numbers (modulo 2 to the 64)."""
    n = len(ids) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out *= _BASE
        out += ids[k : k + n]
    return out


def greedy_tiles(item: np.ndarray, doc: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Tiles (item position, document position, length), longest first, of at least
    ``least`` numbers; number 0 matches nothing. Ties go to the earlier position in
    the item, then in the document."""
    tiles: list[tuple[int, int, int]] = []
    if len(item) < least or len(doc) < least:
        return tiles
    item_hash, doc_hash = rolled(item, least), rolled(doc, least)
    item_free, doc_free = item > 0, doc > 0

    def windows(free: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(free)))
        return total[least:] - total[:-least] == least

    while True:
        item_open, doc_open = windows(item_free), windows(doc_free)
        best, found = 0, []
        before = np.zeros(len(doc_hash), np.int64)
        for i in range(len(item_hash)):
            # Seeds that follow each other on a diagonal make up one longer run.
            now = np.zeros(len(doc_hash), np.int64)
            if item_open[i]:
                at = np.flatnonzero((doc_hash == item_hash[i]) & doc_open)
                at = at[(doc[at] == item[i]) & (doc[at + least - 1] == item[i + least - 1])]
                now[at] = 1
                now[at[at > 0]] += before[at[at > 0] - 1]
                if len(at) and (top := int(now[at].max())) >= best:
                    if top > best:
                        best, found = top, []
                    found += [(i, int(j)) for j in at[now[at] == top]]
            before = now
        if not best:
            return tiles
        length = best + least - 1
        for i, j in sorted((i - best + 1, j - best + 1) for i, j in found):
            if item_free[i : i + length].all() and doc_free[j : j + length].all():
                tiles.append((i, j, length))
                item_free[i : i + length] = False
                doc_free[j : j + length] = False


class Index:
    """Seeds of a block of items; words outside the block have the number 0."""

    def __init__(self, items: list[tuple[int | None, str]], least: int = LEAST) -> None:
        self.least = least
        self.words: dict[str, int] = {}
        self.items = []
        seeds, owners = [], []
        for key, text in items:
            ids = np.array([self.words.setdefault(w, len(self.words) + 1) for w in tokens(text)], np.uint64)
            if not len(ids):
                continue
            # An item shorter than a seed is searched for as a whole.
            size = min(least, len(ids))
            found = np.unique(rolled(ids, size))
            seeds.append(np.stack([found, np.full(len(found), size, np.uint64)]))
            owners.append(np.full(len(found), len(self.items)))
            self.items.append((key, ids))
        self.by_size = {}
        if seeds:
            joined, owner = np.concatenate(seeds, axis=1), np.concatenate(owners)
            for size in np.unique(joined[1]).tolist():
                here = joined[1] == size
                order = np.argsort(joined[0][here], kind="stable")
                self.by_size[int(size)] = (joined[0][here][order], owner[here][order])

    def search(self, text: str | None, coverage: float) -> list[tuple]:
        """(key, tokens, covered, spans) of the items that the text covers enough."""
        if not text or not self.items:
            return []
        get = self.words.get
        words = tokens(text)
        ids = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        near: dict[int, list[int]] = {}
        for size, (hashes, owner) in self.by_size.items():
            total = np.concatenate(([0], np.cumsum(ids > 0)))
            at = np.flatnonzero(total[size:] - total[:-size] == size) if len(ids) >= size else np.zeros(0, int)
            if not len(at):
                continue
            own = np.zeros(len(at), np.uint64)
            for k in range(size):
                own = own * _BASE + ids[at + k]
            low, high = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
            for k in np.flatnonzero(high > low):
                for item in owner[low[k] : high[k]].tolist():
                    span = near.setdefault(item, [int(at[k]), int(at[k])])
                    span[1] = int(at[k])
        found = []
        offsets = None
        for item, (start, last) in sorted(near.items()):
            key, item_ids = self.items[item]
            size = min(self.least, len(item_ids))
            tiles = greedy_tiles(item_ids, ids[start : last + size], size)
            covered = sum(n for _, _, n in tiles)
            if covered >= coverage * len(item_ids):
                if offsets is None:
                    offsets = [m.span() for m in _WORD.finditer(text)]
                    if len(offsets) != len(words):  # lower case changed where words end
                        offsets = [m.span() for m in _WORD.finditer(text.lower())]
                spans = sorted((offsets[start + j][0], offsets[start + j + n - 1][1]) for _, j, n in tiles)
                found.append((key, len(item_ids), covered, spans))
        return found


FOUND = "item_tokens int, covered int, n_tiles int, coverage double, spans array<struct<start:int,end:int>>"


def _indexes(benchmark: DataFrame, least: int, block_bytes: int) -> Iterator[Index]:
    """The benchmark, cut by a hash of its rows into blocks of about ``block_bytes``;
    the driver holds one block at a time."""
    items = benchmark.select("item_id", "text").filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    for number in range(n_blocks):
        rows = items.filter(block == number).orderBy("item_id", "text").collect()
        yield Index([(r.item_id, r.text) for r in rows], least)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = LEAST, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document and benchmark item that it covers to ``coverage`` or more:
    doc_id, item_id, ``item_tokens``, ``covered``, ``n_tiles``, ``coverage`` and the
    ``spans`` of the tiles in the document (code points).

    Words are runs of letters and digits, in any case. Null and empty texts, on either
    side, match nothing; repeated rows are compared row by row.
    """
    kinds = {"doc_id": docs.schema["doc_id"].dataType.simpleString(), "item_id": benchmark.schema["item_id"].dataType.simpleString()}
    schema = f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, {FOUND}"
    id_kind = to_arrow_type(benchmark.schema["item_id"].dataType)
    spans_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    results = []
    for index in _indexes(benchmark, least, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, out = [], []
                for k, text in enumerate(batch.column(1)):
                    for hit in index.search(text.as_py(), coverage):
                        at.append(k)
                        out.append(hit)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at, pa.int64())),
                        pa.array([h[0] for h in out], id_kind),
                        pa.array([h[1] for h in out], pa.int32()),
                        pa.array([h[2] for h in out], pa.int32()),
                        pa.array([len(h[3]) for h in out], pa.int32()),
                        pa.array([h[2] / h[1] for h in out], pa.float64()),
                        pa.array([[{"start": s, "end": e} for s, e in h[3]] for h in out], spans_kind),
                    ],
                    ["doc_id", "item_id", "item_tokens", "covered", "n_tiles", "coverage", "spans"],
                )

        results.append(stored(docs.select("doc_id", "text").mapInArrow(run, schema), "contaminated"))
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return found


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = LEAST, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; columns as they were. Rows
    are judged one by one, so null and repeated ids need no care."""
    place = docs.columns.index("text")
    kept = docs
    for number, index in enumerate(_indexes(benchmark, least, block_bytes)):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not index.search(text.as_py(), coverage) for text in batch.column(place)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        kept = (stored(kept, "clean") if number else kept).mapInArrow(run, docs.schema)
    return kept
