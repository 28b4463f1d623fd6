"""Near duplicates of vectors by NN-descent.

Vectors are compared within their label by cosine in double precision. Equal vectors
are one class with a count, so copies never make pairs. A neighbour graph of the
classes starts from several random-hyperplane codes: classes that follow each other
in the order of a code become neighbours. Rounds of local joins then compare the
neighbours of each class, forward and reverse, with one another and keep the best
``NEIGHBOURS`` of every class, until hardly any list changes.

Edges at or above the threshold are the links. A list full of links may have had
no room for more: such classes get longer lists, as long as their component, whose
members are compared with one another in square tiles. Tiles put out counts, not
pairs. Nor do full lists show links to other components: their classes get lists of
the nearest outside their own one, by the same descent, and components so joined are
looked at again until no link between two is found. Recall is audited with bounded
sets of classes, any and linked ones, against all rows; while it is below the target,
more codes are drawn and the descent goes on, and if that gains nothing the job fails.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanwatch.llm.components import connected
from spanwatch.llm.scratch import discard, stored

THRESHOLD = 0.98
NEIGHBOURS = 8
CODES = 12
CODE_BITS = 32
NEXT = 3
MOST_ROUNDS = 6
SETTLED = 0.005
MEMBERS = 64
TILE = 256
AUDITED = 200
RECALL = 0.97
MOST_PASSES = 3
SEED = 7


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Rows with equal first ``keys`` columns, which arrive together, as one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, bool)
        for k in range(keys):
            column = batch.column(k).to_numpy(zero_copy_only=False)
            changed[1:] |= column[1:] != column[:-1]
        same = held and all(held[-1].column(k)[held[-1].num_rows - 1] == batch.column(k)[0] for k in range(keys))
        cuts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for n, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
            piece = batch.slice(start, end - start)
            if n == 0 and same:
                held.append(piece)
            else:
                if held:
                    yield _joined(held)
                held = [piece]
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _unit(column: pa.Array, kind: str) -> np.ndarray:
    """Vectors of one length as rows of length one, in double precision."""
    x = np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1).astype(np.float64)
    # Scaled first, so that squares neither vanish nor overflow.
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _grouped(frame: DataFrame, keys: list[str], run: Callable, schema: str) -> DataFrame:
    """``run`` on all rows of each value of ``keys``; groups are bounded by their key."""
    dealt = frame.repartition(*keys).sortWithinPartitions(*keys)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[tuple[np.ndarray, ...]] = []
        names = None
        for group in _runs(batches, len(keys)):
            found = run(group)
            if found is None:
                continue
            names = list(found)
            gathered.append(tuple(found.values()))
            if sum(len(g[0]) for g in gathered) > 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*gathered, strict=True)], names)
                gathered = []
        if gathered:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*gathered, strict=True)], names)

    return dealt.mapInArrow(each, schema)


def _first_links(vectors: DataFrame, kind: str, codes: int, offset: int) -> DataFrame:
    """Each class with the ``NEXT`` that follow it in the order of each code."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                unit = _unit(part.column(3), kind)
                width = unit.shape[1]
                if width not in planes:
                    planes[width] = np.random.default_rng([SEED, offset, width]).standard_normal((codes, CODE_BITS, width))
                for c in range(codes):
                    bits = unit @ planes[width][c].T > 0
                    code = bits @ (1 << np.arange(CODE_BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(unit), c, np.int32)), part.column(0), part.column(1), pa.array(code), part.column(2), part.column(3)],
                        ["c", "label", "size", "code", "id", "vec"],
                    )

    def adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            if not batch.num_rows:
                continue
            here = batch if tail is None else pa.Table.from_batches([tail, batch]).combine_chunks().to_batches()[0]
            old = 0 if tail is None else tail.num_rows
            groups = [here.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            ids = here.column(4).to_numpy()
            texts = here.column(5).to_pylist()
            for size in np.unique(groups[2]):
                rows = np.flatnonzero(groups[2] == size)
                unit = _unit(pa.array([texts[r] for r in rows], pa.binary()), kind)
                for step in range(1, NEXT + 1):
                    a, b = np.arange(len(rows) - step), np.arange(step, len(rows))
                    ok = (rows[b] >= old) & (rows[b] - rows[a] <= NEXT)
                    for g in groups:
                        ok &= g[rows[a]] == g[rows[b]]
                    a, b = a[ok], b[ok]
                    sim = (unit[a] * unit[b]).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[rows[a]]), pa.array(ids[rows[b]]), pa.array(sim)], ["a", "b", "sim"])
            tail = here.slice(max(0, here.num_rows - NEXT))

    schema = "c int, label " + vectors.schema["label"].dataType.simpleString() + ", size int, code bigint, id bigint, vec binary"
    order = ["c", "label", "size", "code", "id"]
    ordered = vectors.select("label", "size", "id", "vec").mapInArrow(coded, schema).repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(adjacent, "a bigint, b bigint, sim double")


def _best(pairs: DataFrame, most: int) -> DataFrame:
    """The ``most`` nearest of every class from pairs (a, b, sim, fresh)."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim", "fresh"))
    single = both.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.col("sim").desc(), "b"))
    return single.withColumn("place", place).filter(F.col("place") <= most).drop("place")


def _round(graph: DataFrame, vectors: DataFrame, kind: str, number: int, inner: DataFrame | None = None) -> DataFrame:
    """Pairs of neighbours of one class that are nearer than what their lists hold.

    With ``inner``, neighbours within a component, those take part as well, and only
    pairs of two components (``part`` of ``vectors``) are put out.
    """
    floor = graph.groupBy("a").agg(F.when(F.count(F.lit(1)) >= NEIGHBOURS, F.min("sim")).otherwise(F.lit(-2.0)).alias("floor"))
    ahead = graph.select(F.col("a").alias("pivot"), F.col("b").alias("id"), "fresh")
    both = ahead.unionByName(graph.select(F.col("b").alias("pivot"), F.col("a").alias("id"), "fresh"))
    if inner is not None:
        for pivot, other in (("a", "b"), ("b", "a")):
            both = both.unionByName(inner.select(F.col(pivot).alias("pivot"), F.col(other).alias("id"), F.lit(False).alias("fresh")))
    members = both.groupBy("pivot", "id").agg(F.max("fresh").alias("fresh"))
    # A class that is a neighbour of many is met by them in blocks, dealt anew each round.
    degree = members.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("blocks"))
    dealt = members.join(degree, "pivot").withColumn("block", F.pmod(F.xxhash64("id", F.lit(number)), F.col("blocks")).cast("int"))
    known = vectors.select("id", "vec", F.lit(None).cast("long").alias("part") if inner is None else "part").join(floor.withColumnRenamed("a", "id"), "id", "left")
    placed = dealt.join(known, "id").select("pivot", "block", "id", "fresh", F.coalesce("floor", F.lit(-2.0)).alias("floor"), "vec", "part")
    apart = inner is not None

    def compare(group: pa.RecordBatch) -> dict | None:
        if group.num_rows < 2:
            return None
        ids = group.column(2).to_numpy()
        fresh = group.column(3).to_numpy(zero_copy_only=False).astype(bool)
        floor = group.column(4).to_numpy()
        unit = _unit(group.column(5), kind)
        sim = unit @ unit.T
        better = (sim > np.minimum(floor[:, None], floor[None, :])) & (fresh[:, None] | fresh[None, :])
        if apart:
            part = group.column(6).to_numpy()
            better &= part[:, None] != part[None, :]
        a, b = np.nonzero(np.triu(better, 1))
        return {"a": ids[a], "b": ids[b], "sim": sim[a, b]}

    return _grouped(placed, ["pivot", "block"], compare, "a bigint, b bigint, sim double")


def _descend(graph: DataFrame, vectors: DataFrame, kind: str, first: int, inner: DataFrame | None = None) -> DataFrame:
    """Rounds of local joins until hardly any list changes."""
    for number in range(first, first + MOST_ROUNDS):
        news = _round(graph, vectors, kind, number, inner).withColumn("fresh", F.lit(True))
        olds = graph.select("a", "b", "sim", F.lit(False).alias("fresh"))
        after = stored(_best(olds.unionByName(news), NEIGHBOURS), "graph")
        discard(graph)
        graph = after
        changed, held = graph.agg(F.count_if("fresh"), F.count(F.lit(1))).first()
        if changed <= SETTLED * max(held, 1):
            break
    return graph


def _groups(graph: DataFrame, vectors: DataFrame, kind: str, threshold: float, attempt: int) -> DataFrame:
    """Components (id, component) of the links, between full lists as well.

    A link that neither end's list holds has two ends whose lists are full of nearer
    links. So the classes with such lists look for the nearest ones outside their
    component; a component needs one link to another, as tiles count all the others.
    """
    edges = graph.filter(F.col("sim") >= threshold).select("a", "b")
    parts = stored(connected(edges).select(F.col("node").alias("id"), "component"), "vector-groups")
    full = graph.groupBy("a").agg(F.count(F.lit(1)).alias("held"), F.min("sim").alias("least"))
    full = stored(full.filter((F.col("held") >= NEIGHBOURS) & (F.col("least") >= threshold)).select(F.col("a").alias("id")), "full-lists")
    inner = edges.join(full.withColumnRenamed("id", "a"), "a", "left_semi")
    turn = 0
    while True:
        placed = stored(vectors.join(full, "id", "left_semi").join(parts.withColumnRenamed("component", "part"), "id"), "full-vectors")
        several = placed.groupBy("label", "size").agg(F.min("part").alias("least"), F.max("part").alias("most")).filter("least != most")
        if several.isEmpty():
            return parts
        one, two = (placed.select(F.col("id").alias(c), F.col("part").alias(f"part_{c}")) for c in "ab")
        pairs = _first_links(placed, kind, CODES, 1000 * (attempt + 1) + turn).join(one, "a").join(two, "b").filter("part_a != part_b")
        outer = stored(_best(pairs.select("a", "b", "sim", F.lit(True).alias("fresh")), NEIGHBOURS), "outer-graph")
        known = vectors.join(parts.withColumnRenamed("component", "part"), "id", "left").withColumn("part", F.coalesce("part", "id"))
        outer = _descend(outer, known, kind, turn * MOST_ROUNDS, inner)
        found = stored(outer.filter(F.col("sim") >= threshold).select("a", "b"), "outer-links")
        if found.isEmpty():
            return parts
        edges = edges.unionByName(found)
        parts = stored(connected(edges).select(F.col("node").alias("id"), "component"), "vector-groups")
        turn += 1


def _tiles(parts: DataFrame, vectors: DataFrame, kind: str, threshold: float) -> DataFrame:
    """Links of every class of a component: copies on the other side, summed.

    The lists of a component are as long as the component. It is cut into blocks and
    each pair of blocks is one tile of at most about ``TILE`` squared comparisons.
    """
    sizes = parts.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("blocks"))
    placed = parts.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = placed.select("component", "block", "id", others).select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id"
    )
    ready = tiles.join(vectors.select("id", "n", "vec"), "id").select("component", "i", "j", "block", "id", "n", "vec")

    def compare(group: pa.RecordBatch) -> dict:
        i, j = group.column(1)[0].as_py(), group.column(2)[0].as_py()
        block, ids, n = (group.column(k).to_numpy() for k in (3, 4, 5))
        unit = _unit(group.column(6), kind)
        near = unit @ unit.T >= threshold
        np.fill_diagonal(near, False)
        if i != j:
            near &= block[:, None] != block[None, :]
        return {"id": ids, "links": (near @ n.astype(np.float64)).astype(np.int64)}

    found = _grouped(ready, ["component", "i", "j"], compare, "id bigint, links bigint")
    return found.groupBy("id").agg(F.sum("links").alias("links"))


def _audit(links: DataFrame, vectors: DataFrame, kind: str, threshold: float) -> float:
    """Share of the true links that were found, of bounded sets of classes: the lesser
    of the shares of any classes and of those with links."""
    linked = vectors.join(links.filter("links > 0"), "id", "left_semi")
    return min(_recall(some, links, vectors, kind, threshold) for some in (vectors, linked))


def _recall(some: DataFrame, links: DataFrame, vectors: DataFrame, kind: str, threshold: float) -> float:
    asked = some.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(AUDITED).select("id", "label", "size", "vec").collect()
    by_group: dict[tuple, list] = {}
    for row in asked:
        by_group.setdefault((row.label, row.size), []).append((row.id, bytes(row.vec)))

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            groups: dict[tuple, list[int]] = {}
            for k, key in enumerate(zip(labels, sizes, strict=True)):
                if key in by_group:
                    groups.setdefault(key, []).append(k)
            for key, rows in groups.items():
                part = batch.take(pa.array(rows))
                queries = by_group[key]
                sim = _unit(pa.array([v for _, v in queries], pa.binary()), kind) @ _unit(part.column(4), kind).T
                ids, n = part.column(2).to_numpy(), part.column(3).to_numpy()
                own = np.array([q for q, _ in queries])
                near = (sim >= threshold) & (own[:, None] != ids[None, :])
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array((near @ n.astype(np.float64)).astype(np.int64))], ["id", "true"])

    there = vectors.select("label", "size", "id", "n", "vec").mapInArrow(brute, "id bigint, true bigint").groupBy("id").agg(F.sum("true").alias("true"))
    got = there.join(links, "id", "left").agg(F.sum("true"), F.sum(F.least("true", F.coalesce("links", F.lit(0))))).first()
    return 1.0 if not got[0] else got[1] / got[0]


def link(rows: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """One row per input row: id, ``n_links``, ``component_id`` and ``kept``.

    Vectors that are null, zero, empty or hold null or non-finite components, and
    rows without a label, link with nothing; vectors of different lengths do not link
    either. Repeated rows link with each other. A null id keeps its row; it is the
    component's id only where no other id is in it.
    """
    element = rows.schema[vector_column].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    wide = "array<float>" if kind == "<f4" else "array<double>"
    vector = F.col("vector")
    whole = F.coalesce(
        F.size(vector) > 0, F.lit(False)
    ) & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))), F.lit(False))
    whole &= F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False)) & F.col("label").isNotNull()
    given = stored(
        rows.select(F.col(id_column).alias("id0"), F.col(label_column).alias("label"), F.col(vector_column).cast(wide).alias("vector")).withColumn("valid", whole),
        "vectors",
    )
    classes = given.filter("valid").groupBy("label", "vector").agg(F.min("id0").alias("first"), F.count(F.lit(1)).alias("n"))
    named = classes.withColumn("id", F.monotonically_increasing_id())
    label_kind = named.schema["label"].dataType.simpleString()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(4)
            data = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), kind)
            ends = np.concatenate(([0], np.cumsum(np.diff(lists.offsets.to_numpy()))))
            vec = pa.array([data[s:e].tobytes() for s, e in zip(ends, ends[1:], strict=False)], pa.binary())
            size = pa.array(np.diff(ends).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], size, vec, lists], ["label", "first", "n", "id", "size", "vec", "vector"])

    first_kind = named.schema["first"].dataType.simpleString()
    vectors = stored(
        named.select("label", "first", "n", "id", "vector").mapInArrow(
            packed, f"label {label_kind}, first {first_kind}, n bigint, id bigint, size int, vec binary, vector {wide}"
        ),
        "vector-classes",
    )

    graph, recall, before, attempt = None, 0.0, 0.0, 0
    while recall < RECALL:
        if attempt >= MOST_PASSES and recall <= before:
            raise RuntimeError(f"recall of links is {recall:.3f} after {attempt} passes and no longer grows")
        fresh = _first_links(vectors, kind, CODES, attempt).withColumn("fresh", F.lit(True))
        if graph is not None:
            fresh = fresh.unionByName(graph.select("a", "b", "sim", F.lit(False).alias("fresh")))
        graph = _descend(stored(_best(fresh, NEIGHBOURS), "graph"), vectors, kind, attempt * MOST_ROUNDS)
        parts = _groups(graph, vectors, kind, threshold, attempt)
        links = stored(_tiles(parts, vectors, kind, threshold), "vector-links")
        before, recall = recall, _audit(links, vectors, kind, threshold)
        attempt += 1

    joined = vectors.select("label", "vector", "id", "first", "n").join(parts, "id", "left").join(links, "id", "left")
    joined = joined.withColumn("part", F.coalesce("component", "id"))
    least = joined.groupBy("part").agg(F.min("first").alias("component_id"))
    known = joined.join(least, "part").select("label", "vector", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    linked = given.filter("valid").join(known, ["label", "vector"]).select("id0", "n_links", "component_id")
    alone = given.filter(~F.col("valid")).select("id0", F.lit(0).cast("long").alias("n_links"), F.col("id0").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id0").alias(id_column), F.col("n_links").cast("long").alias("n_links"), "component_id", F.col("id0").eqNullSafe(F.col("component_id")).alias("kept")
    )
