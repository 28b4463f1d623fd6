"""Nearest vectors, prefix trie and periodic runs against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from corpus import SF_DIR, no_docs, odd_docs, read
from pyspark.sql import functions as F

from spanwatch.llm import hnsw, runs, trie
from spanwatch.llm.queries import llm_queries

# Nearest vectors


def true_neighbours(rows, asking, nearest=5):
    """Every query row against all other rows."""
    usable = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    found = []
    for k, (i, v) in enumerate(usable):
        if not asking(i):
            continue
        scored = [(-float(v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w))), j) for m, (j, w) in enumerate(usable) if m != k and len(w) == len(v)]
        found.append((i, [(j, -s) for s, j in sorted(scored, key=lambda x: (round(x[0], 12), x[1]))[:nearest]]))
    return sorted(found, key=repr)


def by_query(frame):
    found = collections.defaultdict(list)
    for r in frame.collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    return {q: sorted(v) for q, v in found.items()}


def test_nearest_query(spark):
    rows = read(spark, "embeddings").select("vec_id", "embedding").collect()
    found = by_query(llm_queries()["op11_nearest_vectors"](spark, SF_DIR))
    want = dict(true_neighbours([tuple(r) for r in rows], lambda i: i % 50 == 0))
    assert found.keys() == want.keys() and all([r for r, _, _ in v] == [1, 2, 3, 4, 5] for v in found.values())
    shared = sum(len({i for _, i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert shared >= 0.95 * 5 * len(want)
    for q, answers in found.items():
        assert [s for _, _, s in answers] == sorted((s for _, _, s in answers), reverse=True)
        true = dict(want[q])
        assert all(abs(true[i] - s) < 1e-12 for _, i, s in answers if i in true)


def test_nearest_of_copies_ties_and_odd_vectors(spark):
    rng = random.Random(4)
    base = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(30)]
    rows = [(k, v) for k, v in enumerate(base)]
    # Copies by the dozen, a doubled vector (the same direction), a row given twice.
    rows += [(100 + k, base[0]) for k in range(12)] + [(200, [2 * x for x in base[0]]), (1, base[1]), (1, base[2])]
    rows += [(300, None), (301, []), (302, [0.0] * 4), (303, [1.0, None, 0.0, 0.0]), (304, [float("nan")] * 4), (305, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(None, base[3]), (400, [1.0, 0.0]), (401, [1e-200, 1e-200]), (402, [1e200, -1e200])]
    frame = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], "vec_id long, embedding array<double>, node int, ids string")
    found = hnsw.nearest_neighbours(frame, F.lit(True)).collect()
    got = collections.Counter((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in found)
    want = collections.Counter((q, k + 1, i, round(s, 9)) for q, answers in true_neighbours(rows, lambda i: True) for k, (i, s) in enumerate(answers))
    # Vectors of extreme size have no exact product in the plain form.
    assert {k: n for k, n in got.items() if k[0] not in (401, 402) and k[2] not in (401, 402)} == {k: n for k, n in want.items() if k[0] not in (401, 402) and k[2] not in (401, 402)}
    assert sorted((r.query_id, r.vec_id) for r in found if r.query_id in (400, 401, 402)) == [(a, b) for a in (400, 401, 402) for b in (400, 401, 402) if a != b]
    assert hnsw.nearest_neighbours(frame.limit(0), F.lit(True)).count() == 0
    assert hnsw.nearest_neighbours(frame.where("vec_id = 5"), F.lit(True)).count() == 0
    assert hnsw.nearest_neighbours(frame, F.lit(False)).count() == 0


def test_graph_finds_its_neighbours():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 16))
    unit = hnsw._unit((centres[rng.integers(0, 40, 3000)] + 0.3 * rng.standard_normal((3000, 16))).astype(np.float32))
    graph = hnsw.Graph(unit)
    found, sims = graph.search(unit[::30], 64)
    true = np.argsort(-(unit[::30] @ unit.T), axis=1)[:, :6]
    assert np.mean([len(set(a[:6]) & set(b)) for a, b in zip(found, true, strict=True)]) / 6 >= 0.95
    again, _ = hnsw.Graph.restore(unit, graph.height, graph.flat()).search(unit[::30], 64)
    assert (again == found).all() and (np.diff(sims, axis=1) <= 0).all()
    assert [len(set(row[row >= 0])) for row in graph.levels[0]] == [(row >= 0).sum() for row in graph.levels[0]]


# Prefix trie


def true_trie(rows):
    convs = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    new = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        new[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in new.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    found = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(new[c]) == len(k)))
        parent = min(members[k[:-1]]) if k else None
        found.append((min(m), len(k), parent, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


TURNS = "conv_id long, turn long, role string, text string, at string, least int"


def test_trie_of_odd_conversations(spark):
    rng = random.Random(2)
    rows = []
    for c in range(40):
        for t in range(rng.choice([0, 1, 2, 5, 9, 19])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["u", "a", None]), rng.choice(["x", "yy", "", None, "zé"])))
    rows += [(None, 1, "u", "q"), (77, 0, "a", "x"), (77, 0, "a", "x")] + [(k, 0, "u", "hello") for k in range(200, 260)] + [(-7, 0, "u", "x")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)
    # A negative number is cut towards zero, as the remainder is.
    rows = [r for r in rows if r[0] != -7]
    turns, convs = trie.share_openings(trie.ordered_turns(frame.where("conv_id IS NULL OR conv_id >= 0")), 5, 9)
    assert sorted(map(tuple, trie.prefix_trie(turns, convs).collect()), key=repr) == true_trie(rows)
    assert trie.ordered_turns(frame).where("conv = -7").count() == 1


def test_trie_query_and_empty_table(spark):
    given = read(spark, "conversations").select("conv_id", "turn", "role", "text")
    found = llm_queries()["op12_prefix_trie"](spark, SF_DIR)
    assert sorted(map(tuple, found.collect()), key=repr) == true_trie([tuple(r) for r in given.collect()])
    turns, convs = trie.share_openings(trie.ordered_turns(given.limit(0)), 5, 9)
    assert trie.prefix_trie(turns, convs).count() == 0


# Periodic runs


def true_runs(words, least=6, repeats=4):
    names = {w: k for k, w in enumerate(dict.fromkeys(words))}
    word, n, found = np.array([names[w] for w in words], np.int64), len(words), []
    for p in range(1, n // repeats + 1):
        equal = np.concatenate(([0], (word[p:] == word[:-p]).astype(np.int8), [0]))
        edges = np.flatnonzero(np.diff(equal)).reshape(-1, 2)
        for s, e in edges[edges[:, 1] - edges[:, 0] + p >= max(least, repeats * p)].tolist():
            part = word[s : e + p]
            if not any((part[q:] == part[:-q]).all() for q in range(1, p)):
                found.append((s, e + p - s, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least, repeats", [(6, 4), (2, 2), (4, 3)])
def test_runs_of_random_words(least, repeats):
    rng = random.Random(least)
    for _ in range(1500):
        letters = rng.randint(1, 4)
        words = [rng.randrange(letters) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            period = [rng.randrange(letters + 1) for _ in range(rng.randint(1, 5))]
            words[len(words) // 2 : len(words) // 2] = (period * 9)[: rng.randint(1, 40)]
        assert [tuple(r) for r in runs.find_runs(words, least, repeats).tolist()] == true_runs(words, least, repeats)
    assert runs.find_runs(["w"] * 30000).tolist() == [[0, 30000, 1]]
    with pytest.raises(ValueError):
        runs.find_runs(["w"], 6, 1)


def test_common_extensions():
    rng = random.Random(8)
    for n in (2, 3, 17, 90, 400):
        word = [rng.randrange(2) for _ in range(n)]
        tree = runs.SuffixTree(word)
        one = np.array([rng.randrange(n) for _ in range(50)])
        two = (one + 1 + np.array([rng.randrange(n - 1) for _ in range(50)])) % n
        for a, b, length in zip(one.tolist(), two.tolist(), tree.extension(one, two).tolist(), strict=True):
            same = 0
            while max(a, b) + same < n and word[a + same] == word[b + same]:
                same += 1
            assert same == length


def true_row(doc_id, text):
    words = (text or "").encode("utf-8", "surrogatepass").split()
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = true_runs(words)
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    gone = {k for s, length, p in found for k in range(s + p, s + length)}
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
    milli = 1000 * top[1] // top[2] if found else None
    return (doc_id, len(found), *top, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_query(spark):
    found = llm_queries()["op13_periodic_runs"](spark, SF_DIR)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [true_row(r.doc_id, r.text) for r in read(spark, "documents").collect()]
    assert sorted(map(tuple, found.select(names).collect())) == sorted(want)
    assert sum(r[1] for r in want) > 5


def test_runs_of_odd_documents(spark, tmp_path):
    texts = [None, "", " \n", "a " * 9, "x y " * 8 + "x z", "ü ü " * 7, "one two", "a b a b a b a b", "a b a b a b a b", "w " * 70000, "\x1ca \x1ca", "k"]
    docs = odd_docs(spark, texts).withColumn("runs", F.lit("clash"))
    found = runs.periodic_runs(docs)
    assert found.columns == [c for c in docs.columns if c != "runs"] + ["n_words", "runs", "collapsed"]
    for r in found.collect():
        words = (r.text or "").encode().split()
        assert r.n_words == len(words) and [tuple(x) for x in r.runs] == (true_runs(words) if len(words) < 1000 else [(0, 70000, 1)])
    assert runs.periodic_runs(no_docs(spark)).count() == 0
    docs.drop("runs").write.parquet(str(tmp_path / "documents.parquet"))
    short = llm_queries()["op13_periodic_runs"](spark, str(tmp_path)).where("doc_id IS NULL OR doc_id <> 9")
    want = [true_row(r.doc_id, r.text) for r in docs.collect() if r.doc_id != 9 and len(r.text or "") < 9000]
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = [tuple(r) for r in short.select(names).collect()]
    assert all(row in got for row in want) and len(got) == docs.where("doc_id IS NULL OR doc_id <> 9").count()
