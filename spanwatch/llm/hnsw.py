"""Approximate nearest neighbours: one navigable small-world graph per shard.

Equal vectors are one node with their smallest ids, as many as an answer can need, so
copies neither fill neighbour lists nor make pairs. Nodes are dealt to shards by a hash
of the vector. Each shard builds a hierarchical graph: a node reaches up to a random
level, gets its neighbours by a beam search from the top, and keeps those that are
nearer to it than to one another. A shard is stored as one row: ids, vectors and, for
each level, one flat array of neighbour numbers.

Blocks of queries visit every shard, and the answers of the shards are merged. Graph
search ranks in single precision; what it returns is measured again in double
precision on the given vectors. Recall is audited with a bounded set of queries against
all rows; below the target the search is repeated with a wider beam.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanwatch.llm.scratch import discard, stored

NEAREST = 5
LINKS = 16
BUILD_BEAM = 64
BEAM = 64
LEAST_SHARD = 1 << 10
MOST_SHARD = 1 << 17
BLOCK = 1 << 12
AUDITED = 200
RECALL = 0.95
SEED = 11
_BATCH = 128
_AT_ONCE = 4
_SALTS = 32
_WIDE = 1 << 14
_SPREAD = 4


class Graph:
    """Hierarchical graph over unit vectors in single precision.

    ``levels[l]`` holds the neighbours of the nodes of level l, ``width(l)`` each, -1 for
    none, and ``members[l]`` the nodes; all nodes are on level 0.
    """

    def __init__(self, unit: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM, seed: int = SEED) -> None:
        self.unit, self.links = unit, links
        n = len(unit)
        draws = np.random.default_rng(seed).random(n)
        height = (-np.log(np.maximum(draws, 1e-12)) / np.log(links)).astype(np.int64)
        # The first node is the entry and reaches every level.
        if n:
            height[0] = height.max()
        self.height = height
        top = int(height[0]) if n else -1
        self.levels = [np.full((n, self.width(level)), -1, np.int32) for level in range(top + 1)]
        done = 1
        while done < n:
            count = min(done, _BATCH, n - done)
            self._insert(np.arange(done, done + count), beam)
            done += count

    def width(self, level: int) -> int:
        return self.links if level else 2 * self.links

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes (-1 for none) and similarities, ``beam`` of each query, best first."""
        entry = np.zeros((len(queries), 1), np.int64)
        for level in range(len(self.levels) - 1, 0, -1):
            entry, _ = self._beam(queries, entry, 1, level)
        return self._beam(queries, entry, beam, 0)

    def _beam(self, queries: np.ndarray, entry: np.ndarray, beam: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        table, n, q = self.levels[level], len(self.unit), len(queries)
        ids = np.full((q, beam), -1, np.int64)
        sims = np.full((q, beam), -np.inf, np.float32)
        open_ = np.zeros((q, beam), bool)
        # The last column takes the marks of missing neighbours.
        seen = np.zeros((q, n + 1), bool)
        seen[:, n] = True
        kept = min(beam, entry.shape[1])
        ids[:, :kept] = entry[:, :kept]
        sims[:, :kept] = np.einsum("qkd,qd->qk", self.unit[entry[:, :kept]], queries)
        sims[ids < 0] = -np.inf
        open_[:, :kept] = ids[:, :kept] >= 0
        seen[np.arange(q)[:, None], ids[:, :kept]] = True
        rows = np.arange(q)
        while True:
            rows = rows[open_[rows].any(axis=1)]
            if not len(rows):
                break
            mine = np.where(open_[rows], sims[rows], -np.inf)
            step = min(_AT_ONCE, beam)
            pick = np.argpartition(-mine, step - 1, axis=1)[:, :step]
            chosen = np.take_along_axis(mine, pick, axis=1) > -np.inf
            nodes = np.where(chosen, np.take_along_axis(ids[rows], pick, axis=1), 0)
            near = np.where(chosen[:, :, None], table[nodes], -1).reshape(len(rows), -1).astype(np.int64)
            open_[rows[:, None], pick] = False
            # Neighbours of two nodes at once may be the same: only the first one counts.
            order = np.argsort(near, axis=1, kind="stable")
            near = np.take_along_axis(near, order, axis=1)
            again = np.zeros(near.shape, bool)
            again[:, 1:] = near[:, 1:] == near[:, :-1]
            fresh = ~seen[rows[:, None], near] & ~again
            seen[rows[:, None], near] = True
            at, place = np.nonzero(fresh)
            if not len(at):
                continue
            found = np.full(near.shape, -np.inf, np.float32)
            found[at, place] = np.einsum("kd,kd->k", self.unit[near[at, place]], queries[rows[at]])
            all_sims = np.concatenate([sims[rows], found], axis=1)
            all_ids = np.concatenate([ids[rows], np.where(fresh, near, -1)], axis=1)
            all_open = np.concatenate([open_[rows], fresh], axis=1)
            best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            sims[rows] = np.take_along_axis(all_sims, best, axis=1)
            ids[rows] = np.take_along_axis(all_ids, best, axis=1)
            open_[rows] = np.take_along_axis(all_open, best, axis=1)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)

    def _insert(self, new: np.ndarray, beam: int) -> None:
        entry = np.zeros((len(new), 1), np.int64)
        among = self.unit[new] @ self.unit[new].T
        for level in range(len(self.levels) - 1, -1, -1):
            linked = self.height[new] >= level
            if not linked.all():
                rows = np.flatnonzero(~linked)
                entry[rows], _ = self._beam(self.unit[new[rows]], entry[rows], 1, level)
            rows = np.flatnonzero(linked)
            if not len(rows):
                continue
            ids, sims = self._beam(self.unit[new[rows]], entry[rows], beam, level)
            entry[rows] = ids[:, :1]
            # Nodes of one batch meet each other directly, the later ones the earlier ones.
            mates = np.broadcast_to(new[rows], (len(rows), len(rows)))
            earlier = new[rows][None, :] < new[rows][:, None]
            ids = np.concatenate([ids, np.where(earlier, mates, -1)], axis=1)
            sims = np.concatenate([sims, np.where(earlier, among[np.ix_(rows, rows)], -np.inf).astype(np.float32)], axis=1)
            chosen = self._select(self.unit[new[rows]], ids, sims, self.links, beam)
            self.levels[level][new[rows], : chosen.shape[1]] = chosen
            self._link_back(new[rows], chosen, level)

    def _select(self, centre: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int, among: int) -> np.ndarray:
        """Neighbours of each row: the nearest ones that are nearer to the centre than to a
        neighbour before them, filled up with the nearest others."""
        among = min(among, ids.shape[1])
        best = np.argsort(-sims, axis=1, kind="stable")[:, :among]
        ids, sims = np.take_along_axis(ids, best, axis=1), np.take_along_axis(sims, best, axis=1)
        there = (ids >= 0) & (sims > -np.inf)
        vectors = self.unit[np.where(there, ids, 0)]
        mutual = vectors @ vectors.transpose(0, 2, 1)
        taken = np.zeros(ids.shape, bool)
        blocked = ~there
        for k in range(ids.shape[1]):
            take = ~blocked[:, k] & (taken.sum(axis=1) < most)
            taken[:, k] = take
            blocked |= take[:, None] & (mutual[:, k, :] > sims)
        rank = np.where(taken, 0, np.where(there, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        order = np.argsort(rank, axis=1, kind="stable")[:, :most]
        return np.where(np.take_along_axis(there, order, axis=1), np.take_along_axis(ids, order, axis=1), -1)

    def _link_back(self, new: np.ndarray, chosen: np.ndarray, level: int) -> None:
        table, width = self.levels[level], self.width(level)
        source = np.repeat(new, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.lexsort((source, target))
        source, target = source[order], target[order]
        nodes, begin, count = np.unique(target, return_index=True, return_counts=True)
        held = (table[nodes] >= 0).sum(axis=1)
        within = np.arange(len(target)) - np.repeat(begin, count)
        fits = held + count <= width
        easy = np.repeat(fits, count)
        table[target[easy], (np.repeat(held, count) + within)[easy]] = source[easy]
        full = np.flatnonzero(~fits)
        full = full[np.argsort(count[full], kind="stable")]
        while len(full):
            # As many nodes at once as their candidates allow.
            wide = int(count[full[: max(1, _WIDE // (width + 1))]].max()) + width
            some, full = full[: max(1, _WIDE // wide)], full[max(1, _WIDE // wide) :]
            wide = int(count[some].max()) + width
            ids = np.full((len(some), wide), -1, np.int64)
            ids[:, :width] = table[nodes[some]]
            for row, k in enumerate(some):
                ids[row, width : width + count[k]] = source[begin[k] : begin[k] + count[k]]
            centre = self.unit[nodes[some]]
            sims = np.einsum("kwd,kd->kw", self.unit[np.where(ids >= 0, ids, 0)], centre)
            table[nodes[some]] = self._select(centre, ids, np.where(ids >= 0, sims, -np.inf), width, wide)

    def flat(self) -> list[np.ndarray]:
        """Neighbour numbers of each level, in the order of its nodes."""
        return [table[self.height >= level].ravel() for level, table in enumerate(self.levels)]

    @classmethod
    def restore(cls, unit: np.ndarray, height: np.ndarray, flat: list[np.ndarray], links: int = LINKS) -> Graph:
        graph = cls.__new__(cls)
        graph.unit, graph.links, graph.height, graph.levels = unit, links, height, []
        for level, part in enumerate(flat):
            width = graph.width(level)
            table = np.full((len(unit), width), -1, np.int32)
            table[height >= level] = part.reshape(-1, width)
            graph.levels.append(table)
        return graph


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Scaled by a power of two each, so squares neither vanish nor overflow; exact."""
    _, power = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -power[:, None])


def cosine(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Cosines of the rows of two equally long matrices, in double precision."""
    one, two = _scaled(one.astype(np.float64)), _scaled(two.astype(np.float64))
    return (one * two).sum(axis=1) / (np.sqrt((one * one).sum(axis=1)) * np.sqrt((two * two).sum(axis=1)))


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = _scaled(vectors.astype(np.float64))
    return (wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))).astype(np.float32)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(-1, size)


def _usable(vector: Column) -> Column:
    """True where the vector has a direction: whole, finite and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_nodes(rows: DataFrame, id_column: str, vector_column: str, nearest: int) -> DataFrame:
    """One row per distinct vector: node, size, vector and its ``nearest`` + 1 smallest
    ids. Equal vectors are equally near to everything and ties go to smaller ids, so no
    answer needs more of them."""
    given = rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"))
    given = given.filter(F.col("id").isNotNull() & _usable(F.col("vector")))
    # Copies are thinned out in salted parts first, so a very common vector is many tasks.
    salt = F.pmod(F.xxhash64("id"), F.lit(_SALTS)).alias("salt")
    for keys in (["vector", "salt"], ["vector"]):
        given = given.withColumn("salt", salt) if "salt" in keys else given
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("id"))
        given = given.withColumn("place", place).filter(F.col("place") <= nearest + 1).drop("place")
    nodes = given.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return nodes.select(F.monotonically_increasing_id().alias("node"), F.size("vector").alias("size"), "vector", "ids")


def build_index(nodes: DataFrame, links: int = LINKS, beam: int = BUILD_BEAM) -> DataFrame:
    """One row per shard: size, shard, node numbers, vectors, ids and the flat graph.

    There are as many shards as shuffle partitions, unless they would be larger than
    ``MOST_SHARD`` vectors, which bounds a task's memory, or smaller than ``LEAST_SHARD``.
    """
    width = max(1, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shards = F.greatest(F.ceil(F.col("n") / MOST_SHARD), F.least(F.lit(width), F.ceil(F.col("n") / LEAST_SHARD))).cast("int")
    # One row for each length of vector.
    sizes = nodes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).select("size", shards.alias("shards"))
    dealt = nodes.join(F.broadcast(sizes), "size").withColumn("shard", F.pmod(F.xxhash64("vector", F.lit(SEED)), F.col("shards")).cast("int"))
    dealt = dealt.select("size", "shard", F.xxhash64("vector").alias("place"), "node", "vector", "ids")
    # A number of its own keeps shards from being put together for their few bytes.
    dealt = dealt.repartition(_SPREAD * width, "size", "shard").sortWithinPartitions("size", "shard", "place", "vector")
    element = nodes.schema["vector"].dataType.elementType.simpleString()
    kind = pa.float32() if element == "float" else pa.float64()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 2):
            size = group.column(0)[0].as_py()
            vectors = _matrix(group.column(4), size)
            graph = Graph(_unit(vectors), links, beam)
            columns = [
                pa.array([size], pa.int32()),
                pa.array([group.column(1)[0].as_py()], pa.int32()),
                pa.array([group.column(3).to_numpy()], pa.list_(pa.int64())),
                pa.array([vectors.ravel()], pa.list_(kind)),
                pa.array([group.column(5).to_pylist()], pa.list_(pa.list_(pa.int64()))),
                pa.array([graph.height.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([[part for part in graph.flat()]], pa.list_(pa.list_(pa.int32()))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["size", "shard", "nodes", "vectors", "ids", "height", "links"])

    schema = f"size int, shard int, nodes array<bigint>, vectors array<{element}>, ids array<array<bigint>>, height array<int>, links array<array<int>>"
    return dealt.mapInArrow(build, schema)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Rows with equal first columns, which arrive together, as one batch each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        changed = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        cuts = [0, *changed.tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[begin] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(batch.slice(begin, end - begin))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def search_index(index: DataFrame, queries: DataFrame, nearest: int, beam: int) -> DataFrame:
    """The ``nearest`` + 1 best (place, score, id, node) of every query node (node, size,
    vector), its own rows included: query, best. Blocks of queries meet every shard of their size."""
    element = queries.schema["vector"].dataType.elementType.simpleString()
    counts = queries.groupBy("size").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    shards = index.groupBy("size").agg((F.max("shard") + 1).alias("shards"))
    # One row for each length of vector.
    plan = F.broadcast(counts.join(shards, "size"))
    asked = queries.join(plan, "size").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    packed = asked.groupBy("size", "shards", "block").agg(F.collect_list(F.struct("node", "vector")).alias("asked"))
    packed = packed.select("size", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "block", "asked")
    spread = index.join(plan, "size").select(*index.columns, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    width = _SPREAD * max(1, int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = ["size", "shard", "block"]
    met = spread.repartition(width, *keys).join(packed.repartition(width, *keys), keys).select("size", "vectors", "ids", "height", "links", "asked", "nodes")
    keep = nearest + 1

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                size, ids = batch.column(0)[k].as_py(), batch.column(2)[k].as_py()
                numbers = batch.column(6)[k].values.to_numpy()
                vectors = batch.column(1)[k].values.to_numpy(zero_copy_only=False).reshape(-1, size)
                flat = [part.values.to_numpy(zero_copy_only=False) for part in batch.column(4)[k]]
                graph = Graph.restore(_unit(vectors), batch.column(3)[k].values.to_numpy(zero_copy_only=False), flat)
                asked = batch.column(5)[k].values
                names = asked.field("node").to_numpy()
                wanted = _matrix(asked.field("vector"), size)
                for low in range(0, len(names), _BATCH):
                    part = wanted[low : low + _BATCH]
                    found, _ = graph.search(_unit(part), min(beam, max(keep, len(vectors))))
                    q, place = np.nonzero(found >= 0)
                    node = found[q, place]
                    score = cosine(part[q], vectors[node])
                    many = np.array([len(ids[m]) for m in node.tolist()], np.int64)
                    rows = np.repeat(np.arange(len(q)), many)
                    every = np.array([i for m in node.tolist() for i in ids[m]], np.int64)
                    order = np.lexsort((every, -score[rows], q[rows]))
                    q_of, rank = q[rows][order], np.arange(len(order))
                    first = np.searchsorted(q_of, q_of)
                    best = order[rank - first < keep]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[low + q[rows[best]]]), pa.array(score[rows[best]]), pa.array(every[best]), pa.array(numbers[node[rows[best]]])],
                        ["query", "score", "id", "node"],
                    )

    found = met.mapInArrow(answer, "query bigint, score double, id bigint, node bigint")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "id"))
    best = found.withColumn("place", place).filter(F.col("place") <= keep)
    # At most that many rows of a query are left.
    entries = F.array_sort(F.collect_list(F.struct("place", "score", "id", "node")))
    return best.groupBy("query").agg(entries.alias("best"))


def _recall(nodes: DataFrame, queries: DataFrame, answers: DataFrame, nearest: int) -> float:
    """Share of the true answers of a bounded set of queries that were found."""
    asked = queries.orderBy(F.xxhash64("node", F.lit(SEED)), "node").limit(AUDITED).select("node", "size", "vector").collect()
    if not asked:
        return 1.0
    by_size: dict[int, tuple] = {}
    for size in {r.size for r in asked}:
        own = [r for r in asked if r.size == size]
        by_size[size] = (np.array([r.node for r in own]), np.array([r.vector for r in own], np.float64))
    keep = nearest + 1

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(0).to_numpy()
            for size, (names, wanted) in by_size.items():
                part = batch.filter(pa.array(sizes == size))
                if not part.num_rows:
                    continue
                vectors, ids = _matrix(part.column(1), size), part.column(2).to_pylist()
                near = _unit(wanted) @ _unit(vectors).T
                some = min(len(vectors), 4 * keep)
                q = np.repeat(np.arange(len(names)), some)
                node = np.argpartition(-near, some - 1, axis=1)[:, :some].ravel()
                score = cosine(wanted[q], vectors[node])
                rows = [(names[a], s, i) for a, s, m in zip(q.tolist(), score.tolist(), node.tolist(), strict=True) for i in ids[m]]
                a, s, i = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(s, pa.float64()), pa.array(i, pa.int64())], ["query", "score", "id"])

    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "id"))
    true = nodes.select("size", "vector", "ids").mapInArrow(brute, "query bigint, score double, id bigint").withColumn("place", place).filter(F.col("place") <= keep)
    got = answers.select("query", F.explode("best").alias("e")).select("query", "e.id", F.lit(1).alias("got"))
    some = got.join(F.broadcast(true.select("query").distinct()), "query")
    row = true.join(some, ["query", "id"], "left").agg(F.count(F.lit(1)), F.count("got")).first()
    return row[1] / row[0] if row[0] else 1.0


def nearest_neighbours(
    rows: DataFrame,
    chosen: Column,
    nearest: int = NEAREST,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    beam: int = BEAM,
    recall: float = RECALL,
) -> DataFrame:
    """The ``nearest`` rows by cosine of every row for which ``chosen`` holds, but itself:
    query_id, rank (from 1), vec_id and score, ties to the smaller id.

    Rows whose id or vector is null, or whose vector is empty, zero or holds null or
    non-finite components, take no part; vectors of different lengths are no neighbours.
    A repeated row is a candidate of its own, and asks for itself. With fewer candidates
    there are fewer rows, with none there are none. Other columns are ignored.
    """
    nodes = stored(vector_nodes(rows, id_column, vector_column, nearest), "vector-nodes")
    asking = rows.filter(chosen).select(F.col(id_column).cast("long").alias("query_id"), F.col(vector_column).alias("vector"))
    asking = asking.filter(F.col("query_id").isNotNull() & _usable(F.col("vector")))
    # Equal queries are answered once.
    asking = stored(asking.join(nodes.select("node", "vector"), "vector").select("query_id", F.col("node").alias("query")), "query-rows")
    queries = stored(nodes.join(asking.select(F.col("query").alias("node")).distinct(), "node", "left_semi").select("node", "size", "vector"), "query-nodes")
    index = stored(build_index(nodes), "vector-shards")
    answers, found, before = None, 0.0, -1.0
    while found < recall:
        if found <= before:
            raise RuntimeError(f"recall is {found:.3f} with beams of {beam // 2} and no longer grows")
        if answers is not None:
            discard(answers)
        answers = stored(search_index(index, queries, nearest, beam), "nearest")
        before, found = found, _recall(nodes, queries, answers, nearest)
        beam *= 2
    for done in (index, queries, nodes):
        discard(done)
    # A query is one of the rows of its own node.
    best = F.col("best")
    own = F.array_position(F.transform(best, lambda e: (e["id"] == F.col("query_id")) & (e["node"] == F.col("query"))), True).cast("int")
    joined = asking.join(answers, "query").withColumn("own", own)
    others = F.when(F.col("own") > 0, F.filter(best, lambda e, k: k != F.col("own") - 1)).otherwise(best)
    top = F.slice(others, 1, nearest)
    return joined.select("query_id", F.posexplode(top).alias("at", "e")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.id").alias("vec_id"), F.col("e.score").alias("score")
    )
