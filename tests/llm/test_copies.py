"""SimHash groups, vector links, repeated bytes and passages against brute force."""

import hashlib
import itertools
import os
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from corpus import SF_DIR, components, no_docs, odd_docs, read, sentence
from pyspark.sql import functions as F

from spanwatch.llm import components as comp
from spanwatch.llm import neighbours, passages, simhash, suffixes
from spanwatch.llm.queries import llm_queries
from spanwatch.llm.scratch import stored


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 480)] + [(5, 5)]
    found = {r.node: r.component for r in comp.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components({x for e in edges for x in e}, edges)
    assert all(found.get(i, i) == c for i, c in want.items())
    assert comp.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_query(spark):
    docs = read(spark, "documents").collect()
    found = {r.doc_id: r for r in llm_queries()["op10_simhash"](spark, SF_DIR).collect()}
    prints = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    assert {i: int(r.fingerprint, 16) for i, r in found.items()} == prints
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert {i: r.component_id for i, r in found.items()} == components(prints, near)


def test_every_pair_within_four_bits_is_linked(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(60)]
    prints = set(base)
    for value in base:
        for bits in range(1, 7):
            prints.add(value ^ sum(1 << b for b in rng.sample(range(64), bits)))
    dense = rng.getrandbits(64)
    prints |= {dense ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)}
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    classes = spark.createDataFrame([(p, 1) for p in signed], "fp long, n long")
    found = {r.node: r.component for r in comp.connected(simhash.links(classes)).collect()}
    near = [(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert {p: found.get(p, p) for p in signed} == components(signed, near)


def test_filed_and_looked_up_fingerprints_are_not_broadcast(spark):
    # Small tables by Spark's reckoning, which does not count what an explode adds.
    classes = stored(spark.range(200).select(F.xxhash64("id").alias("fp"), F.lit(1).cast("long").alias("n")), "few-classes")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    for frame in (simhash._stars(simhash._filed(classes)), simhash.links(classes)):
        assert "Broadcast" not in frame._jdf.queryExecution().explainString(mode)


def test_simhash_of_odd_rows(spark):
    docs = odd_docs(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    empty = [r for r in rows if r.fp == 0]
    assert len(empty) >= 3 and {r.component_id for r in empty} == {0}
    kept = simhash.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    assert texts.count("same text here") == 1 and len([t for t in texts if not (t or "").split()]) == 1
    assert simhash.near_duplicates(no_docs(spark)).count() == 0 and simhash.drop_copies(no_docs(spark)).count() == 0


def cosine_links(rows):
    unit = {}
    for i, v, label in rows:
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, np.float64)
            unit[i] = (label, a / np.sqrt((a * a).sum()))
    return [
        (a, b)
        for a, b in itertools.combinations(unit, 2)
        if unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= 0.98
    ]


def test_vectors(spark):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(12):
        centre = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 30))):
            rows.append((len(rows), (centre + 0.03 * rng.standard_normal(16)).astype(np.float32).tolist(), c % 3))
    rows += [(1000 + k, rows[0][1], rows[0][2]) for k in range(20)]  # copies
    rows += [
        (2000, None, 1), (2001, [0.0] * 16, 1), (2002, [None] + [1.0] * 15, 1), (2003, [float("nan")] + [1.0] * 15, 1),
        (2004, [float("inf")] + [1.0] * 15, 1), (2005, rows[0][1], None), (2006, [], 1), (2007, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = {r.vec_id: r for r in neighbours.link(frame).collect()}
    linked = cosine_links(rows)
    ids = [r[0] for r in rows]
    many = {i: 0 for i in ids}
    for a, b in linked:
        many[a] += 1
        many[b] += 1
    assert {i: r.n_links for i, r in found.items()} == many
    want = components(ids, linked)
    assert {i: r.component_id for i, r in found.items()} == want
    assert all(r.kept == (want[i] == i) for i, r in found.items())


def test_lists_full_of_links_grow(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(24)
    rows = [(i, (centre + 0.02 * rng.standard_normal(24)).tolist(), 0) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r.n_links for r in neighbours.link(frame).collect()}
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    assert [found[i] for i in range(600)] == ((unit @ unit.T >= 0.98).sum(1) - 1).tolist()


def test_tight_groups_in_a_wide_one(spark):
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(24)
    centre /= np.linalg.norm(centre)
    rows = []
    for _ in range(40):
        own = centre + 0.014 * rng.standard_normal(24)
        rows += [(len(rows) + k, (own + 0.0005 * rng.standard_normal(24)).tolist(), 0) for k in range(12)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r for r in neighbours.link(frame).collect()}
    linked = cosine_links(rows)
    many = dict.fromkeys(found, 0)
    for a, b in linked:
        many[a] += 1
        many[b] += 1
    assert min(many.values()) > 11 and {i: r.n_links for i, r in found.items()} == many
    assert {i: r.component_id for i, r in found.items()} == components(many, linked)
    assert sum(r.kept for r in found.values()) == 1


def test_recall_below_the_target_fails(spark, monkeypatch):
    rows = [(i, [1.0, 0.001 * i], 0) for i in range(20)]
    monkeypatch.setattr(neighbours, "_audit", lambda *args: 0.5)
    with pytest.raises(RuntimeError, match="recall"):
        neighbours.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert neighbours.link(none).count() == 0
    alone = spark.createDataFrame([(None, [1.0], 1), (4, [1.0], 1), (4, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted((r.vec_id is None, r.n_links, r.component_id) for r in neighbours.link(alone).collect()) == [(False, 2, 4), (False, 2, 4), (True, 2, 4)]


def plain_repeats(texts, length, first=False):
    starts = {}
    data = [(t or "").encode() for t in texts]
    for r, b in enumerate(data):
        for s in range(len(b) - length + 1):
            starts.setdefault(b[s : s + length], []).append((r, s))
    out = []
    for r, b in enumerate(data):
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            where = starts[b[s : s + length]]
            if len(where) > 1 and not (first and where[0] == (r, s)):
                gone[s : s + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeated_texts():
    rng = random.Random(9)
    shared = [sentence(rng, n) for n in (40, 41, 45, 60, 150)]
    texts = [sentence(rng, 30) + rng.choice(shared)[rng.randrange(30) :] + sentence(rng, 20) for _ in range(40)]
    texts += [shared[4] + "é" + shared[4][3:], "ab" * 400, "ab" * 150, None, "", "x" * 199, "x" * 200, "y" * 201, shared[2], shared[2]]
    return texts


@pytest.mark.parametrize("keep", ["none", "first"])
def test_repeated_bytes(spark, keep):
    texts = repeated_texts()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    found = sorted(suffixes.remove_repeats(docs, keep=keep).collect(), key=lambda r: r.doc_id)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found] == plain_repeats(texts, 200, keep == "first")
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.spans) == r.n_spans for r in found)


def test_repeated_bytes_query(spark):
    docs = read(spark, "documents").collect()
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in llm_queries()["op4_repeated_bytes"](spark, SF_DIR).collect()}
    assert found == dict(zip((d.doc_id for d in docs), plain_repeats([d.text for d in docs], 200), strict=True))


def longest_previous_factors(texts):
    """By the whole suffix order: common prefixes with the previous and next smaller position."""
    suffix = sorted(((t.encode()[p:], r, p) for r, t in enumerate(texts) for p in range(len(t.encode()))))
    common = [0] + [len(os.path.commonprefix([a[0], b[0]])) for a, b in zip(suffix, suffix[1:], strict=False)]
    found = {}
    for side in (1, -1):
        order, shared = (suffix, common) if side == 1 else (suffix[::-1], [0, *common[:0:-1]])
        stack = []
        for (_, r, p), least in zip(order, shared, strict=True):
            while stack and stack[-1][0] > (r, p):
                least = min(least, stack.pop()[1])
            found[r, p] = max(found.get((r, p), 0), least if stack else 0)
            stack.append(((r, p), least))
    return found


def test_earlier_matches_are_the_longest_previous_factors(spark):
    rng = random.Random(5)
    line = sentence(rng, 14)[:70]  # a bucket of its own in many surroundings
    texts = [sentence(rng, 25) + line + sentence(rng, 25) for _ in range(60)] + [sentence(rng, 20) + line * 8 for _ in range(3)]
    texts += [texts[k][40:] for k in (3, 3, 9)] + ["ab" * 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "row long, text string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        runs = suffixes.repeats(docs, 200).filter("earlier").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    starts = {(r.row, p) for r in runs for p in range(r.start, r.end - 199)}
    assert starts == {place for place, size in longest_previous_factors(texts).items() if size >= 200}


@pytest.mark.parametrize("ranges", [1, 2, 5, 40])
def test_ranges_of_the_order(spark, ranges):
    rng = np.random.default_rng(ranges)
    k = np.sort(rng.choice([1, 2, 3, 3, 3, 4, 5, 6, 6], 40))
    u = np.concatenate([np.sort(rng.integers(0, 3, n)) for n in np.unique_counts(k).counts])
    columns = [np.arange(40), np.arange(40), np.zeros(40, np.int32), np.full(40, 9, np.int32), k, u]
    nodes = pa.RecordBatch.from_arrays([*map(pa.array, columns)], suffixes._ORDERED[1:7])
    rows = []
    for part, where in enumerate(np.array_split(np.arange(40), ranges)):
        here = nodes.take(pa.array(where))
        rows += [r for b in suffixes._in_order((here[i : i + 3] for i in range(0, len(here), 3)), part) for r in b.to_pylist()]
    order = spark.createDataFrame([tuple(r.values()) for r in rows], suffixes._ORDER)
    found = suffixes._stitched(order, suffixes._borders(order)).collect()
    pairs = list(zip(k.tolist(), u.tolist(), strict=True))
    expected = {i: (pairs.count(p), len(set(u[k == p[0]])), pairs.index(p)) for i, p in enumerate(pairs) if (k == p[0]).sum() > 1}
    assert {r["row"]: (r["same"], r["differ"], r["first_row"], r["first_at"]) for r in found} == {i: (n > 1, c > 1, f, f) for i, (n, c, f) in expected.items()}


def test_repeated_bytes_of_odd_rows(spark):
    assert suffixes.remove_repeats(odd_docs(spark)).count() == 12
    assert suffixes.remove_repeats(no_docs(spark)).count() == 0


def test_long_texts_are_cut_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENT", 300)
    hashers = suffixes.Hasher(0, 500), suffixes.Hasher(1, 500)
    text = sentence(random.Random(2), 400)
    starts = []
    for start, data in suffixes._segments(text, 200):
        at, lo, hi, _, _ = suffixes.runs(data, hashers, 200, 64)
        for a, low, high in zip(at + start, lo, hi, strict=True):
            starts += range(a - high, a - low + 1)
    assert sorted(starts) == list(range(len(text) - 199))


def test_chains_by_fenwick_tree_match_all_pairs(monkeypatch):
    monkeypatch.setattr(passages, "LEAST_SEEDS", 1)
    monkeypatch.setattr(passages, "LEAST_SPAN", 0)
    rng = random.Random(1)
    for _ in range(40):
        n = rng.randint(1, 40)
        points = sorted({(rng.randrange(120), rng.randrange(120)) for _ in range(n)})
        x, y = (np.array(c) for c in zip(*points, strict=True))
        best = [1.0] * len(points)
        for i, (a, b) in enumerate(points):
            for j, (c, d) in enumerate(points):
                if c < a and d < b:
                    best[i] = max(best[i], best[j] + 1 - passages.GAP_COST * (a - c + b - d))
        found = passages.chains(x, y)
        path = found[0]
        cost = sum(int(x[q] - x[p] + y[q] - y[p]) for p, q in itertools.pairwise(path.tolist()))
        assert abs(len(path) - passages.GAP_COST * cost - max(best)) < 1e-9
        assert all(x[p] < x[q] and y[p] < y[q] for p, q in itertools.pairwise(path.tolist()))
        assert sorted(k for p in found for k in p.tolist()) == list(range(len(points)))


def test_passages(spark):
    rng = random.Random(11)
    passage = sentence(rng, 70).split()
    edited = passage.copy()
    edited[20] = "changed"
    del edited[45]
    texts = [f"{sentence(rng, 60)} {' '.join(p)} {sentence(rng, 50)}" for p in (passage, passage, edited, passage[:30])] + [sentence(rng, 200) for _ in range(5)]
    texts += [None, "", "short"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, words string").coalesce(1)
    found = passages.shared_passages(docs).collect()
    assert {r.doc_id for r in found} | {r.other_id for r in found} == {0, 1, 2}
    for r in found:
        part = texts[r.doc_id].split()[r.start : r.end]
        assert part[0] == passage[0] and part[-1] == passage[-1] and r.similarity >= 0.8 and 68 <= r.words <= 71
        if {r.doc_id, r.other_id} == {0, 1}:
            assert r.similarity == 1 and texts[r.other_id].split()[r.other_start : r.other_end] == passage
    assert passages.shared_passages(no_docs(spark)).count() == 0
    assert passages.shared_passages(odd_docs(spark)).count() >= 1


def test_parts_of_an_alignment_match_all_pairs():
    rng = random.Random(8)
    for _ in range(60):
        x = y = 0
        words = []
        for _ in range(rng.randint(2, 6)):
            share = rng.choice((0.3, 0.75, 0.9, 1))
            for _ in range(rng.randint(3, 25)):
                x, y = x + 1 + (rng.random() < 0.03), y + 1 + (rng.random() < 0.03)
                if rng.random() < share:
                    words.append((x, y))
        if not words:
            continue
        xs, ys = (np.array(c) for c in zip(*words, strict=True))

        def holds(s, e, xs=xs, ys=ys):
            spans = int(xs[e] - xs[s]) + 1, int(ys[e] - ys[s]) + 1
            return min(spans) >= 10 and 10 * (e - s + 1) >= 8 * max(spans)

        valid = [(s, e) for s in range(len(xs)) for e in range(s, len(xs)) if holds(s, e)]
        found = passages.passages_of(xs, ys, 0.8, 10)
        assert all(holds(*f) for f in found) and all(a[1] < b[0] for a, b in itertools.pairwise(found))
        # Every passage there is touches one that is given.
        assert all(any(s <= f[1] and e >= f[0] for f in found) for s, e in valid)


@pytest.mark.parametrize("sizes", [(60, 60, 60), (100, 60, 100), (100, 120, 100), (200, 300, 200), (60, 60, 60, 60, 60)])
def test_passages_with_other_words_between(spark, sizes):
    rng = random.Random(14)
    shared = [sentence(rng, n) if k % 2 == 0 else None for k, n in enumerate(sizes)]
    texts = [" ".join([sentence(rng, 30), *(p or sentence(rng, n) for p, n in zip(shared, sizes, strict=True)), sentence(rng, 30)]) for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    starts = [30 + sum(sizes[:k]) for k in range(0, len(sizes), 2)]
    want = {(s, s + sizes[2 * k]) for k, s in enumerate(starts)}
    found = passages.shared_passages(docs).collect()
    # Letters are few: a word beside a passage may be equal by chance.
    assert {min(want, key=lambda w: abs(w[0] - r.start)) for r in found} == want
    for r in found:
        s, e = min(want, key=lambda w: abs(w[0] - r.start))
        assert abs(r.start - s) <= 2 and abs(r.end - e) <= 2 and r.similarity >= 0.9


def replaced(rng, words, n):
    """The words with ``n`` of them, at random places, replaced."""
    words = words.copy()
    for k in rng.sample(range(len(words)), n):
        words[k] = "new" + str(rng.randrange(10**9))
    return words


def test_recall_of_fuzzy_passages(spark):
    """Pairs of texts around two forms of one passage, whose similarity is known as words
    are only replaced; the first and last word stay, so the length is that of the passage."""
    rng = random.Random(21)
    texts, cases = [], []
    for words, share in itertools.product((55, 60, 80, 150), (0.95, 0.9, 0.85)):
        for _ in range(30):
            passage = sentence(rng, words).split()
            edited = passage[:1] + replaced(rng, passage[1:-1], round(words * (1 - share))) + passage[-1:]
            assert sum(a == b for a, b in zip(passage, edited, strict=True)) >= 0.8 * words
            cases.append((words, share))
            texts += [" ".join([sentence(rng, 40), *p, sentence(rng, 40)]) for p in (passage, edited)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = passages.shared_passages(stored(docs, "texts")).collect()
    found = {(r.doc_id, r.other_id) for r in rows}
    assert all(a // 2 == b // 2 and (b, a) in found for a, b in found)
    for case in set(cases):
        own = [k for k, c in enumerate(cases) if c == case]
        assert sum((2 * k, 2 * k + 1) in found for k in own) >= 0.9 * len(own), case


def test_variants_of_one_passage_are_all_found(spark):
    rng = random.Random(22)
    passage = sentence(rng, 60).split()
    texts = [" ".join([sentence(rng, 30), *replaced(rng, passage, 6), sentence(rng, 30)]) for _ in range(40)] + [sentence(rng, 120) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert {r.doc_id for r in passages.shared_passages(stored(docs, "texts")).collect()} == set(range(40))


def test_each_occurrence_meets_the_first_holder_and_the_one_before():
    rng = random.Random(23)
    for _ in range(200):
        seen = sorted({(rng.randrange(4), rng.randrange(6), rng.randrange(5)) for _ in range(rng.randint(0, 40))})
        h, row = (np.array([s[k] for s in seen], np.int64) for k in (0, 1))
        i, j, first = passages.holders(h, row)
        want = set()
        for k, (seed, text, _) in enumerate(seen):
            texts = sorted({s[1] for s in seen if s[0] == seed})
            assert first[k] == (text == texts[0])
            if text > texts[0]:
                want |= {(k, min(q for q, s in enumerate(seen) if s[:2] == (seed, t))) for t in (texts[0], texts[texts.index(text) - 1])}
        assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(want)


def test_matches_are_the_same_over_small_batches_and_blocks(spark, monkeypatch):
    rng = random.Random(24)
    line = sentence(rng, 30)
    texts = [f"{sentence(rng, 8)} {line} {sentence(rng, 8)} {line if k % 3 == 0 else ''}" for k in range(60)]
    docs = stored(spark.createDataFrame([(k, t, k) for k, t in enumerate(texts)], "id long, text string, row long").coalesce(1), "texts")
    rows = lambda: {(r.row, r.other, r.x, r.y) for r in passages.matches(docs).collect()}
    one_block = rows()
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    assert rows() == one_block
    # With one text a block nothing is matched before the exchange.
    monkeypatch.setattr(passages, "BLOCK", 0)
    assert rows() == one_block
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_all_occurrences_of_frequent_seeds_are_matched(spark, monkeypatch):
    rng = random.Random(31)
    line = sentence(rng, 12)
    texts = [f"{sentence(rng, 8)} {line} {sentence(rng, 8)} {line if k % 3 == 0 else ''} {line if k % 6 == 0 else ''}" for k in range(45)]
    docs = stored(spark.createDataFrame([(k, t, k) for k, t in enumerate(texts)], "id long, text string, row long").coalesce(3), "texts")
    where = {}
    for k, text in enumerate(texts):
        for h, x in zip(*passages.seeds(passages.word_hashes(text, suffixes.Hasher(0, suffixes.SEGMENT))), strict=True):
            where.setdefault(int(h), []).append((k, int(x)))
    assert any(len(v) > passages.FEW for v in where.values())
    want = {(i, j, x, y) for v in where.values() for i, x in v for j, y in v if i > j}
    for part in (passages.PART, 7):
        monkeypatch.setattr(passages, "PART", part)
        assert {(r.row, r.other, r.x, r.y) for r in passages.matches(docs).collect() if r.y >= 0} == want


def test_all_pairs_of_texts_with_a_passage_are_found(spark):
    rng = random.Random(32)
    passage = sentence(rng, 60).split()
    # A word more in some, so that windows around a seed alone do not show the passage.
    forms = [[*passage[: 24 + k // 3], "more", *passage[24 + k // 3 :]] if k % 2 else passage for k in range(36)]
    texts = [" ".join([sentence(rng, 20), *form, sentence(rng, 20)]) for form in forms]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {(r.doc_id, r.other_id) for r in passages.shared_passages(stored(docs, "texts")).collect()}
    assert found == {(i, j) for i in range(36) for j in range(36) if i != j}


@pytest.mark.parametrize(("copies", "tile"), [(1, None), (40, None), (40, 16)])
def test_pair_with_other_holders_of_its_seeds_is_found(spark, monkeypatch, copies, tile):
    """Every seed of the passage also stands in texts before and between the two."""
    if tile:
        monkeypatch.setattr(passages, "TILE", tile)
    rng = random.Random(25)
    passage = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    filler = lambda n: " ".join(f"f{rng.randrange(10**9)}" for _ in range(n))

    def pieces():
        parts = [" ".join(passage[k : k + 13]) for k in range(0, 60, 7)]
        rng.shuffle(parts)
        return " ".join(f"{p} {filler(60)}" for p in parts)

    both = [f"{filler(70)} {' '.join(replaced(rng, passage, k))} {filler(70)}" for k in (0, 4)]
    texts = [*(pieces() for _ in range(copies)), both[0], *(pieces() for _ in range(copies)), both[1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = passages.shared_passages(stored(docs, "texts")).collect()
    assert {(r.doc_id, r.other_id) for r in found} == {(copies, 2 * copies + 1), (2 * copies + 1, copies)}
    assert all(65 <= r.start <= 75 and 125 <= r.end <= 135 and r.similarity >= 0.8 for r in found)


def test_joining_pairs_match_all_pairs(monkeypatch):
    rng = np.random.default_rng(26)
    for cells in (1, 1 << 15):
        monkeypatch.setattr(passages, "CELLS", cells)
        for _ in range(30):
            n = int(rng.integers(2, 60))
            forms = rng.integers(1, 1 << 16, (4, 36), np.uint16)
            words = forms[rng.integers(0, 4, n)]
            other = rng.random((n, 36)) < rng.choice((0.05, 0.15, 0.3), (n, 1))
            words = np.where(other, rng.integers(1, 1 << 16, (n, 36), np.uint16), words)
            words[np.arange(36) < rng.choice((0, 0, 5, 20), (n, 1))] = 0
            row, tile = rng.integers(0, n, n), rng.integers(0, 2, n)
            pairs = []
            for i, j in itertools.combinations(range(n), 2):
                equal = np.flatnonzero((words[i] == words[j]) & (words[i] != 0))
                holds = any(equal[t] - equal[s] >= 19 and t - s + 1 >= 0.8 * (equal[t] - equal[s] + 1) for s, t in itertools.combinations(range(len(equal)), 2))
                assert passages.holding(words, np.array([i]), np.array([j]), 0.8, 20)[0] == holds
                if holds and row[i] != row[j] and (tile.min() == tile.max() or tile[i] != tile[j]):
                    pairs.append((i, j))
            found = passages.joining(words, row, tile, 0.8, 20)
            assert set(found) <= set(pairs) and len(found) < n
            assert components(range(n), found) == components(range(n), pairs)


def test_passages_query_finds_exact_repeats(spark):
    docs = read(spark, "documents").collect()
    runs = {}
    for d in docs:
        words = "".join(c.lower() if c.isalnum() or ord(c) > 127 else " " for c in d.text).split()
        if len(set(words)) < 0.3 * len(words):
            continue  # one word over and over
        for k in range(len(words) - 54):
            runs.setdefault(tuple(words[k : k + 55]), set()).add(d.doc_id)
    shared = set().union(*[s for s in runs.values() if len(s) > 1])
    found = llm_queries()["op2_shared_passages"](spark, SF_DIR).collect()
    assert shared and shared <= {r.doc_id for r in found} | {r.other_id for r in found}
