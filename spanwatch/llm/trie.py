"""Prefix trie of conversations by the van Emde Boas recursion.

Sequences of up to 2^K turns are cut at half depth. Every distinct upper half under a
root is one path of the upper trie, and its end is a named cut; the lower halves that
follow one cut are a trie of their own with that cut as root. Upper trie and lower
forests are cut again in the same step, as rows of one table, so all tries of height
2^k are cut at once and K steps lead to single turns, however long a conversation is.
Equal paths under one root are one row with a count, so shared openings and copies are
cut once.

Names are 128-bit digests. A run of turns is named from its two halves, bottom up, so
no task ever needs a whole conversation; a cut is named from its root and the run that
leads to it. Every depth is cut exactly once, so every node has one name: the tip of the
path that ends there, which is handed down until the path is a single turn.

Totals are grafted upwards: a node belongs to the forests of the cuts it was reached
through, at most one for each step, so one aggregation gives the totals of all forests.
The forest of a cut hangs below the end of its upper path; step by step a path hands
what hangs below its end to its halves, until it is a single node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.numbering import numbered
from spanwatch.llm.scratch import discard, stored

_ROOT = bytes(16)
_PIECE = 1 << 16
_AT_ONCE = 4


def _name(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def turn_name(role: Column, text: Column) -> Column:
    """Name of a turn; the length of the role keeps role and text apart."""
    return _name(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv, at (0, 1, ...), name and bytes (of the text) of every turn.

    Turns are ordered by ``turn``, nulls first; equal ones by role and text, and repeated
    rows are turns of their own. Null roles and texts count as empty. Rows with a null
    ``conv_id`` belong to no conversation and are left out. A conversation is numbered by
    ranges, so one of any length is never one task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text")
    )
    rows = rows.withColumns({"name": turn_name(F.col("role"), F.col("text")), "bytes": F.octet_length("text").cast("long")})
    placed = numbered(rows, ["conv", "turn", "role", "text"], keep=["conv", "name", "bytes"])
    first = placed.groupBy("conv").agg(F.min("row").alias("first"))
    return placed.join(first, "conv").select("conv", (F.col("row") - F.col("first")).alias("at"), "name", "bytes")


def share_openings(turns: DataFrame, every: int, modulus: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt so that neighbours share openings: turns and conversations.

    Conversation c starts with the first h turns of c - c % ``every`` (all if it has
    fewer, none if there is no such one), h being the crc32 of its decimal number modulo
    ``modulus``; its own turns after the first h follow.
    """
    turns = stored(turns, "turns")
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("turns"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % modulus).cast("long")
    convs = sizes.select("conv", h.alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    known = sizes.select(F.col("conv").alias("base"), F.col("turns").alias("there"))
    convs = stored(convs.join(known, "base", "left").withColumn("kept", F.least("h", F.coalesce("there", F.lit(0)))), "conversations")
    openings = turns.filter(F.col("at") < modulus - 1).withColumnRenamed("conv", "base")
    opening = convs.join(openings, "base").filter(F.col("at") < F.col("h")).select("conv", "at", "name", "bytes")
    own = turns.join(convs.select("conv", "h", "kept"), "conv").filter(F.col("at") >= F.col("h"))
    own = own.select("conv", (F.col("kept") + F.col("at") - F.col("h")).alias("at"), "name", "bytes")
    return opening.unionByName(own), convs.select("conv")


def _named_runs(turns: DataFrame, height: int) -> list[DataFrame]:
    """For k = 0 .. ``height``, the runs of 2^k turns at multiples of 2^k: conv, j, run,
    len, bytes, and the two halves. The last run of a conversation may be shorter."""
    levels = [turns.select("conv", F.col("at").alias("j"), F.col("name").alias("run"), F.lit(1).cast("long").alias("len"), "bytes")]
    for _ in range(height):
        even = F.col("j") % 2 == 0
        halves = levels[-1].groupBy("conv", F.shiftright("j", 1).alias("j")).agg(
            F.max(F.when(even, F.col("run"))).alias("left"),
            F.max(F.when(~even, F.col("run"))).alias("right"),
            F.max(F.when(even, F.col("len"))).alias("left_len"),
            F.max(F.when(even, F.col("bytes"))).alias("left_bytes"),
            F.max(F.when(~even, F.col("bytes"))).alias("right_bytes"),
            F.sum("len").alias("len"),
            F.sum("bytes").alias("bytes"),
        )
        run = _name(F.col("left"), F.coalesce("right", F.lit(b"")))
        levels.append(stored(halves.withColumn("run", run), "runs"))
    return levels


def _cut(paths: DataFrame, runs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Paths of height 2^k cut in two: each with its halves, and the paths of half the
    height.

    A path is known by its smallest conversation and its place, which no other path of
    the height shares, so it finds its halves by a unique key.
    """
    halves = runs.select(F.col("conv").alias("least"), "j", "left", "left_len", "left_bytes", "right", "right_bytes")
    cut = paths.drop("run", "bytes").join(halves, ["least", "j"])
    cut = stored(cut.withColumn("up", _name(F.col("root"), F.col("left"))), "cuts")
    # The other keys follow from the name.
    upper = cut.groupBy("up", "root", "left", "left_len", "left_bytes", "j", "chain").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max(F.when(F.col("right").isNull(), F.col("ends"))).alias("ends")
    )
    upper = upper.select(
        F.col("up").alias("id"),
        "root",
        F.col("left").alias("run"),
        F.col("left_bytes").alias("bytes"),
        (2 * F.col("j")).alias("j"),
        "n",
        "least",
        "ends",
        F.when(F.col("left_len") == 1 << (k - 1), F.col("up")).alias("tip"),
        "chain",
    )
    through = F.array(F.struct(F.col("up").alias("name"), F.lit(k).alias("step")))
    lower = cut.filter(F.col("right").isNotNull()).select(
        _name(F.col("up"), F.col("right")).alias("id"),
        F.col("up").alias("root"),
        F.col("right").alias("run"),
        F.col("right_bytes").alias("bytes"),
        (2 * F.col("j") + 1).alias("j"),
        "n",
        "least",
        "ends",
        "tip",
        F.concat("chain", through).alias("chain"),
    )
    return cut.select("id", "up", "right"), stored(upper.unionByName(lower), "paths")


def _digests(members: DataFrame) -> DataFrame:
    """run, ends (its smallest conversation) and the SHA-256 of its conversations, joined
    by commas in ascending order.

    Members are joined to pieces by range, so the task that reads the pieces of one run
    in order holds one piece at a time.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, first, held, size = None, None, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([run], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(held)])], ["run", "first", "text"])

        for batch in batches:
            for now, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (now != run or size > _PIECE):
                    yield piece()
                    held, size = [], 0
                if not held:
                    run, first = now, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield piece()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, least, digest = None, None, None

        def out(done: list[tuple[bytes, int, str]]) -> pa.RecordBatch:
            kinds = (pa.binary(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], ["run", "ends", "sha"])

        for batch in batches:
            done = []
            for now, first, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now == run:
                    digest.update(b"," + text.encode())
                else:
                    if digest is not None:
                        done.append((run, least, digest.hexdigest()))
                    run, least, digest = now, first, hashlib.sha256(text.encode())
            if done:
                yield out(done)
        if digest is not None:
            yield out([(run, least, digest.hexdigest())])

    width = max(1, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["run", "conv"]
    pieces = members.select(*order).repartitionByRange(width, *order).sortWithinPartitions(*order).mapInArrow(joined, "run binary, first bigint, text string")
    return pieces.repartition("run").sortWithinPartitions("run", "first").mapInArrow(hashed, "run binary, ends bigint, sha string")


def _grafted(steps: dict[int, DataFrame], forests: DataFrame, height: int) -> DataFrame:
    """id, leaves and saved of every single turn that something hangs below."""
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]

    def hung(k: int) -> DataFrame:
        return forests.filter(F.col("step") == k).select(F.col("name").alias("id"), "leaves", "saved")

    below = hung(height)
    for k in range(height - 1, 0, -1):
        # Below the end of a path is below the ends of both its halves.
        passed = steps[k].filter("right is not null").join(below, "id")
        both = F.explode(F.array(F.col("up"), _name(F.col("up"), F.col("right")))).alias("id")
        below = passed.select(both, "leaves", "saved").unionByName(hung(k)).groupBy("id").agg(*sums)
        if k % _AT_ONCE == 0:
            below = stored(below, "below")
    return stored(below, "below")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node, a distinct sequence of first turns.

    ``turns`` has conv, at (0, 1, ... without gaps), name (binary) and bytes, ``convs``
    has conv, every conversation once, those without turns included. The columns are
    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs
    (members), n_children, n_leaves (nodes without children in the subtree),
    saved_tokens (over the subtree, (n_convs - 1) times the bytes of the last turn) and
    ends_sha256 (of the members that end here). Without conversations there are no rows.
    """
    turns, convs = stored(turns, "sequences"), stored(convs, "conversations")
    longest = turns.agg(F.max("at")).first()[0]
    height = int(longest).bit_length() if longest is not None else 0
    runs = _named_runs(turns, height)
    root, zero = F.lit(_ROOT), F.lit(0).cast("long")

    whole = runs[-1].select("conv", "run")
    classes = runs[-1].groupBy("run", "bytes").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("least"))
    paths = classes.select(
        _name(root, F.col("run")).alias("id"),
        root.alias("root"),
        "run",
        "bytes",
        zero.alias("j"),
        "n",
        "least",
        F.col("least").alias("ends"),
        F.lit(None).cast("binary").alias("tip"),
        F.array().cast("array<struct<name:binary,step:int>>").alias("chain"),
    )
    steps = {}
    for k in range(height, 0, -1):
        before = paths
        steps[k], paths = _cut(paths, runs[k], k)
        if k < height:
            discard(before)
            discard(runs[k])

    # Paths of one turn are the nodes. A path as long as all steps has no tip, nor children.
    nodes = paths.withColumns({"depth": F.col("j") + 1, "tip": F.coalesce("tip", "id")})
    kids = nodes.groupBy(F.col("root").alias("tip")).agg(F.count(F.lit(1)).alias("children"))
    nodes = nodes.join(kids, "tip", "left").withColumn("children", F.coalesce("children", zero))
    own = {"leaf": (F.col("children") == 0).cast("long"), "saved": (F.col("n") - 1) * F.col("bytes")}
    nodes = stored(nodes.withColumns(own).drop("run", "bytes", "j"), "nodes")
    forests = nodes.select(F.explode("chain").alias("c"), "leaf", "saved").groupBy("c.name", "c.step")
    forests = stored(forests.agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved")), "forests")
    below = _grafted(steps, forests, height).withColumnsRenamed({"leaves": "more_leaves", "saved": "more_saved"})
    for done in (forests, *steps.values()):
        discard(done)

    turnless = convs.join(whole, "conv", "left_anti").select("conv", root.alias("run"))
    digests = stored(_digests(whole.unionByName(turnless)), "digests")

    parents = nodes.select(F.col("tip").alias("root"), F.col("least").alias("parent_conv_id"))
    smallest = convs.agg(F.min("conv")).first()[0]
    full = nodes.filter("depth > 1").join(parents, "root")
    full = full.unionByName(nodes.filter("depth = 1").withColumn("parent_conv_id", F.lit(smallest).cast("long")))
    full = full.join(below, "id", "left").select(
        F.col("least").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        (F.col("leaf") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved_tokens"),
        "ends",
    )
    # Most nodes may be no one's end; they need not meet in the join.
    ended = full.filter("ends is not null").join(digests.filter(F.col("run") != root).select("ends", "sha"), "ends")
    passing = full.filter("ends is null").withColumn("sha", F.sha2(F.lit(""), 256))

    # The root, from one row of each of three tables.
    facts = [
        convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")),
        nodes.agg(F.count_if(F.col("depth") == 1).alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")),
        digests.filter(F.col("run") == root).select("sha"),
    ]
    known = facts[0].unionByName(facts[1], allowMissingColumns=True).unionByName(facts[2], allowMissingColumns=True)
    known = known.agg(*[F.max(c).alias(c) for c in known.columns]).filter("n_convs > 0")
    origin = known.select(
        "conv_id",
        zero.alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        # A root without children is a leaf itself.
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
    return ended.unionByName(passing).drop("ends").withColumnRenamed("sha", "ends_sha256").unionByName(origin)
