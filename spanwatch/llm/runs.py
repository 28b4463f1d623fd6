"""Periodic runs in the words of a text.

A run is a stretch of words with smallest period q that no neighbouring word extends.
Every run holds Lyndon roots: with the words ordered, or in the inverse order, the
longest Lyndon word that starts at some place of the run is exactly one period long
(the runs theorem). So the candidates are the longest Lyndon words of every start in
both orders, two for each word. The end of the longest Lyndon word is the next start
whose suffix is smaller, which the order of the suffixes gives.

Each candidate is extended to both sides by longest common extensions: the depth of
the lowest common ancestor of two leaves in the suffix tree (Ukkonen) of the words,
and of the reversed words to the left. The ancestor is the shallowest node between the
two leaves of an Euler tour; a table of minima over blocks of the tour answers that in
constant time and linear space.

A word of a run of period q stands again q words before or after. A run that repeats
at least ``repeats`` times within n words has q <= n / repeats; words whose next equal
word is further off are cut out first, and again by the length of each piece that is
left, until all words are near enough to an equal one: no run holds a word that is cut
out, and trees are only built of what remains.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 6
REPEATS = 4
_BLOCK = 16
_FLUSH = 1 << 24
RUN = "struct<start:bigint,length:bigint,period:bigint>"


class SuffixTree:
    """Suffix tree of whole numbers (Ukkonen) with constant-time common extensions.

    The end of the word is a symbol of its own that is smaller than all others in
    either order.
    """

    def __init__(self, word: list[int], ranks: bool = True) -> None:
        self.word = [*word, -1]
        self._build()
        self._tour()
        if ranks:
            self.inverse_rank = self._ranks(self._inverse_order())
        del self.edges, self.starts, self.ends

    def _build(self) -> None:
        word, n = self.word, len(self.word)
        starts, ends, links = [0], [0], [0]
        # Leaves have no edges.
        edges: list[dict[int, int] | None] = [{}]
        node, edge, length, left = 0, 0, 0, 0
        for at in range(n):
            symbol = word[at]
            left += 1
            inner = 0
            while left:
                if not length:
                    edge = at
                child = edges[node].get(word[edge])
                if child is None:
                    edges[node][symbol if not length else word[edge]] = len(starts)
                    starts.append(at)
                    ends.append(n)
                    links.append(0)
                    edges.append(None)
                    if inner:
                        links[inner] = node
                    inner = 0
                else:
                    span = min(ends[child], at + 1) - starts[child]
                    if length >= span:
                        node, edge, length = child, edge + span, length - span
                        continue
                    middle = starts[child] + length
                    if word[middle] == symbol:
                        length += 1
                        if inner:
                            links[inner] = node
                        break
                    split = len(starts)
                    starts += [starts[child], at]
                    ends += [middle, n]
                    links += [0, 0]
                    edges += [{word[middle]: child, symbol: split + 1}, None]
                    edges[node][word[edge]] = split
                    starts[child] = middle
                    if inner:
                        links[inner] = split
                    inner = split
                left -= 1
                if node:
                    node = links[node]
                elif length:
                    length -= 1
                    edge = at - left + 1
        self.starts, self.ends, self.edges = starts, ends, edges

    def _tour(self) -> None:
        """String depths along an Euler tour, the visit of every suffix and its rank."""
        starts, ends, edges, n = self.starts, self.ends, self.edges, len(self.word)
        depths: list[int] = []
        visit = [0] * n
        order: list[int] = []
        stack = [(0, 0, iter(sorted(edges[0].items())))]
        depths.append(0)
        while stack:
            _, depth, rest = stack[-1]
            for _, child in rest:
                below = depth + ends[child] - starts[child]
                if edges[child]:
                    stack.append((child, below, iter(sorted(edges[child].items()))))
                    depths.append(below)
                else:
                    # A leaf is visited once and left again.
                    visit[n - below] = len(depths)
                    order.append(n - below)
                    depths += (below, depth)
                    continue
                break
            else:
                stack.pop()
                if stack:
                    depths.append(stack[-1][1])
        self.rank = self._ranks(order)
        self.visit = np.array(visit, np.int64)
        blocks = -(-len(depths) // _BLOCK)
        padded = np.full(blocks * _BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(depths)] = depths
        self.depths = padded
        table = [padded.reshape(blocks, _BLOCK).min(axis=1)]
        while 2 << (len(table) - 1) <= blocks:
            step = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-step], table[-1][step:]))
        self.table = table

    def _inverse_order(self) -> list[int]:
        """Suffixes with the symbols in inverse order; the end stays the smallest."""
        starts, ends, edges, n = self.starts, self.ends, self.edges, len(self.word)
        order: list[int] = []
        todo = [(0, 0)]
        while todo:
            node, depth = todo.pop()
            if not edges[node]:
                order.append(n - depth)
                continue
            # The last one pushed is the next one taken.
            below = sorted(edges[node].items())
            if below[0][0] < 0:
                below.append(below.pop(0))
            todo += [(child, depth + ends[child] - starts[child]) for _, child in below]
        return order

    @staticmethod
    def _ranks(order: list[int]) -> list[int]:
        rank = [0] * len(order)
        for place, suffix in enumerate(order):
            rank[suffix] = place
        return rank

    def extension(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Longest common prefixes of the suffixes at ``one`` and ``two`` (different)."""
        a, b = self.visit[one], self.visit[two]
        a, b = np.minimum(a, b), np.maximum(a, b)
        first, last = a // _BLOCK, b // _BLOCK
        inside = np.arange(_BLOCK)
        most = np.iinfo(np.int32).max

        def within(block: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            values = self.depths[block[:, None] * _BLOCK + inside]
            keep = (inside >= low[:, None]) & (inside <= high[:, None])
            return np.where(keep, values, most).min(axis=1)

        found = np.minimum(
            within(first, a % _BLOCK, np.where(first == last, b % _BLOCK, _BLOCK - 1)),
            within(last, np.where(first == last, a % _BLOCK, 0), b % _BLOCK),
        )
        wide = last - first - 1
        for level in range(len(self.table)):
            at = np.flatnonzero((wide >= 1 << level) & (wide < 2 << level))
            if len(at):
                low, high = first[at] + 1, last[at] - (1 << level)
                found[at] = np.minimum(found[at], np.minimum(self.table[level][low], self.table[level][high]))
        return found.astype(np.int64)


def _lyndon(rank: list[int], n: int) -> np.ndarray:
    """End of the longest Lyndon word of every start: the next smaller suffix."""
    after = [n] * (n + 1)
    for i in range(n - 1, -1, -1):
        own, j = rank[i], i + 1
        while j < n and rank[j] > own:
            j = after[j]
        after[i] = j
    return np.array(after[:n], np.int64)


def _runs_of_piece(word: list[int], least: int, repeats: int) -> np.ndarray:
    n = len(word)
    ahead = SuffixTree(word)
    symbols = np.array(word)
    starts, ends = [], []
    for rank in (ahead.rank, ahead.inverse_rank):
        end = _lyndon(rank, n)
        at = np.flatnonzero(end < n)
        # The word after a root in a run repeats the first word of the root.
        at = at[symbols[at] == symbols[end[at]]]
        starts.append(at)
        ends.append(end[at])
    pairs = np.unique(np.stack([np.concatenate(starts), np.concatenate(ends)], axis=1), axis=0)
    if not len(pairs):
        return np.zeros((0, 3), np.int64)
    one, two = pairs[:, 0], pairs[:, 1]
    right = ahead.extension(one, two)
    # The first root of a run starts in its first period, so the rest lies to its right.
    first = right > (repeats - 2) * (two - one)
    one, two, right = one[first], two[first], right[first]
    period, left = two - one, np.zeros(len(one), np.int64)
    inner = np.flatnonzero(one > 0)
    if len(inner):
        left[inner] = SuffixTree(word[::-1], ranks=False).extension(n - one[inner], n - two[inner])
    length = period + left + right
    found = np.stack([one - left, length, period], axis=1)[length >= np.maximum(least, repeats * period)]
    return np.unique(found, axis=0)


def _pieces(word: np.ndarray, least: int, repeats: int) -> list[tuple[int, int]]:
    """Bounds of the stretches in which every word is near enough to an equal one."""
    n = len(word)
    order = np.argsort(word, kind="stable")
    gap = np.where(np.diff(word[order]) == 0, np.diff(order), n)
    near = np.full(n, n, np.int64)
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    allowed = np.full(n, n // repeats)
    while True:
        flags = np.concatenate(([False], near <= allowed, [False]))
        bounds = np.flatnonzero(flags[1:] != flags[:-1]).reshape(-1, 2)
        sizes = bounds[:, 1] - bounds[:, 0]
        most = np.where(sizes >= least, sizes // repeats, 0)
        now = np.zeros(n, np.int64)
        now[flags[1:-1]] = np.repeat(most, sizes)
        if np.array_equal(now, allowed):
            return [(low, high) for low, high in bounds[most > 0].tolist()]
        allowed = now


def find_runs(words: list, least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """Rows (start, length, period) of all runs of ``words`` that are at least ``least``
    words and ``repeats`` periods long (two or more), by start and period."""
    if repeats < 2:
        raise ValueError("a run repeats its period at least twice")
    if len(words) < max(least, 2):
        return np.zeros((0, 3), np.int64)
    names = {w: k for k, w in enumerate(dict.fromkeys(words))}
    whole = np.fromiter(map(names.__getitem__, words), np.int64, len(words))
    found = []
    for low, high in _pieces(whole, least, repeats):
        rows = _runs_of_piece(whole[low:high].tolist(), least, repeats)
        if len(rows):
            found.append(rows + np.array([low, 0, 0]))
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.concatenate(found)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapse(words: list, runs: np.ndarray) -> list:
    """``words`` without those that a run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return [words[k] for k in kept.tolist()]


def periodic_runs(docs: DataFrame, text_column: str = "text", least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length and period in words, by start)
    and ``collapsed``, the words that stay when every run keeps one period.

    Words stand between ASCII white space. Null and empty texts have no words, no runs
    and an empty ``collapsed``. Every row is looked at on its own: repeated rows and null
    ids give rows like any other, an empty table gives none. Other columns pass through,
    but those named like the three new ones are replaced.
    """
    new = ["n_words", "runs", "collapsed"]
    kept = docs.drop(*new)
    # All columns travel as one, so their names can't meet those used here.
    rows = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("doc"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])), pa.string()]

        def out(doc: pa.Array, found: list[tuple]) -> pa.RecordBatch:
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([doc, *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], ["doc", *new])

        for batch in batches:
            found, begin, held = [], 0, 0
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_py() or ""
                words = text.encode("utf-8", "surrogatepass").split()
                runs = find_runs(words, least, repeats)
                collapsed = b" ".join(collapse(words, runs)).decode("utf-8", "surrogatepass")
                found.append((len(words), [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()], collapsed))
                held += len(collapsed)
                if held > _FLUSH:
                    yield out(batch.column(0).slice(begin, k + 1 - begin), found)
                    found, begin, held = [], k + 1, 0
            if found:
                yield out(batch.column(0).slice(begin), found)

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, n_words bigint, runs array<{RUN}>, collapsed string").select("doc.*", *new)
