"""Mixing, decontamination, classifiers, page text and personal data."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from corpus import SF_DIR, labels, no_docs, odd_docs, read, sentence

from spanwatch.llm import decontaminate, htmltext, labelled, mixing, quality, sanitise, toxicity
from spanwatch.llm.queries import llm_queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(totals):
    names = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    goal, whole = {}, 1.5 * sum(totals.values())
    while True:
        rest = [s for s in names if s not in goal]
        left = whole - sum(goal.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if share[s] >= 2 * totals[s]]
        if not above:
            return goal | share
        goal |= {s: 2.0 * totals[s] for s in above}
        if len(goal) == len(names):
            return goal


def check_mix(rows, texts):
    assert sorted(r.size for r in rows) == sorted(len(WORD.findall(t or "")) for t in texts)
    totals = {}
    for r in rows:
        totals[r.source] = totals.get(r.source, 0) + r.size
    goal = plain_targets(totals)
    for r in rows:
        assert r.source_size == totals[r.source] and r.target == pytest.approx(goal[r.source])
        assert 0 <= r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
    for source, target in goal.items():
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - target) <= max([r.size for r in own]) / 2 + 1


@pytest.mark.parametrize("block", [128, 3])
def test_mix(spark, block):
    rng = random.Random(4)
    rows = [(i, sentence(rng, int(rng.paretovariate(1.1) * 5) % 900), rng.choice(["a", "ä", "z", "Z", None, "b", "hot", "hot", "hot"])) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(docs, block=block).collect()
    check_mix(found, [r[1] for r in rows])
    again = mixing.mix(docs.repartition(5), block=block).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, again), key=repr)


def test_mix_query(spark):
    check_mix(llm_queries()["op3_mix_sources"](spark, SF_DIR).collect(), [r.text for r in read(spark, "documents").collect()])


def test_mix_of_odd_rows(spark):
    docs = odd_docs(spark)
    check_mix(mixing.mix(docs).collect(), [r.text for r in docs.collect()])
    taken = mixing.take(docs)
    assert taken.columns[: len(docs.columns)] == docs.columns and all(r.mix_copies > 0 for r in taken.collect())
    assert mixing.mix(no_docs(spark)).count() == 0
    blank = spark.createDataFrame([(1, " ", "s"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.taken, r.target) for r in mixing.mix(blank).collect()] == [(0, 0.0)] * 2


def test_texts_of_blocks_are_not_broadcast(spark):
    # Their blocks are a small table by Spark's reckoning.
    docs = spark.createDataFrame([(i, "word " * (i % 7 + 1), "s") for i in range(300)], "doc_id long, text string, source string")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    assert "Broadcast" not in mixing.mix(docs, block=16)._jdf.queryExecution().explainString(mode)


def test_copies_are_unbiased(spark):
    """Expected copies of every text are its share, over many seeds."""
    docs = spark.createDataFrame([(i, "w " * (3 + i % 4), "one" if i < 12 else "two") for i in range(24)], "doc_id long, text string, source string")
    total = np.zeros(24)
    seeds = 12
    for seed in range(seeds):
        mixing.SEED = seed
        for r in mixing.mix(docs).collect():
            total[r.doc_id] += r.copies
            share = r.target / r.source_size
            assert int(share) <= r.copies <= int(share) + 1
    assert abs(total[:12].sum() / 12 / seeds - 2.0) < 0.01


def plain_tiles(a, b, least):
    """Greedy tiling by looking at every pair of positions."""
    free_a, free_b, covered = [True] * len(a), [True] * len(b), 0
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return covered
        for k in range(n):
            free_a[i + k] = free_b[j + k] = False
        covered += n


def test_tiles_match_plain_tiling():
    rng = random.Random(6)
    for _ in range(60):
        a = [rng.randint(1, 4) for _ in range(rng.randint(1, 25))]
        b = [rng.randint(0, 4) for _ in range(rng.randint(1, 40))]
        tiles = decontaminate.greedy_tiles(np.array(a, np.uint64), np.array(b, np.uint64), 3)
        assert sum(n for _, _, n in tiles) == plain_tiles(a, b, 3)
        for i, j, n in tiles:
            assert a[i : i + n] == b[j : j + n]


def test_contaminated(spark):
    rng = random.Random(8)
    item = sentence(rng, 40)
    words = item.split()
    moved = " ".join(words[20:] + words[:20])
    half = " ".join(words[:20])
    texts = [f"{sentence(rng, 30)} {item.upper()}! {sentence(rng, 5)}", f"{sentence(rng, 9)} {moved}", half, sentence(rng, 60), None, "", "Tiny item", f"so tiny, item {sentence(rng, 9)}"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (None, "tiny item"), (5, "!!!")], "item_id long, text string")
    for size in (1 << 20, 100):
        found = decontaminate.contaminated(docs, bench, block_bytes=size).collect()
        assert {(r.doc_id, r.item_id) for r in found} == {(0, 1), (1, 1), (6, None), (7, None)}
        by = {r.doc_id: r for r in found}
        assert by[0].n_tiles == 1 and by[1].n_tiles == 2 and by[1].coverage == 1.0
        s = by[0].spans[0]
        assert texts[0][s.start : s.end].lower() == item
        clean = decontaminate.decontaminate(docs, bench, block_bytes=size)
        assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [2, 3, 4, 5]
    nothing = bench.limit(0)
    assert decontaminate.contaminated(docs, nothing).count() == 0 and decontaminate.decontaminate(docs, nothing).count() == 8
    assert decontaminate.contaminated(no_docs(spark), bench).count() == 0
    assert decontaminate.decontaminate(odd_docs(spark), bench).count() == 12


def test_contaminated_query(spark):
    def flat(text):
        return " ".join(re.findall(r"[^\W_]+", text.lower()))

    items = [flat(r.text) for r in read(spark, "benchmark").collect()]
    docs = {r.doc_id: f" {flat(r.text)} " for r in read(spark, "documents").collect()}
    whole = {i for i, t in docs.items() if any(f" {x} " in t for x in items)}
    assert {r.doc_id for r in llm_queries()["op1_decontaminate"](spark, SF_DIR).collect()} >= whole


def test_held_out_rule(spark):
    ids = [0, 1, 17, 123456, None]
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    found = [r[0] for r in frame.select(labelled.remainder(frame.doc_id, 4)).collect()]
    assert found == [zlib.crc32(("" if i is None else str(i)).encode()) % 4 for i in ids]


def plain_marginals(odds, first, enter, leave):
    """Sum over all label sequences."""
    n = len(odds)
    weight = np.zeros((n, 2))
    for code in range(1 << n):
        y = [code >> k & 1 for k in range(n)]
        score = sum(o for o, v in zip(odds, y, strict=True) if v)
        for k in range(n):
            before = 0 if first[k] else y[k - 1]
            score += enter if (before, y[k]) == (0, 1) else leave if (before, y[k]) == (1, 0) else 0.0
        for k in range(n):
            weight[k, y[k]] += np.exp(score)
    return weight[:, 1] / weight.sum(1)


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 11):
        odds = rng.normal(size=n) * 2
        first = rng.random(n) < 0.3
        first[0] = True
        got = toxicity.forward_backward(odds, first, -1.0, 0.5)[0]
        assert np.allclose(got, plain_marginals(odds, first, -1.0, 0.5))


def toy_labelled(spark):
    rng = random.Random(12)
    rows, marks = [], []
    for i in range(400):
        words = sentence(rng, rng.randint(20, 80)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["zzkfool", "zzkcreep", "zzkscum"]))
        text = " ".join(words)
        if i % 5 == 1:
            text = " ".join(w.upper() + "!!" for w in words)
        rows.append((i, text))
        marks.append((i, 0 if i % 5 == 1 else 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), labels(spark, marks), dict((i, (q, t)) for i, q, t in marks)


def test_classifiers_learn(spark):
    docs, marks, truth = toy_labelled(spark)
    toxic = toxicity.score_toxicity(docs, marks).collect()
    assert sum(r.predicted == truth[r.doc_id][1] for r in toxic if r.held_out) >= 0.95 * sum(r.held_out for r in toxic)
    texts = {r.doc_id: r.text for r in docs.collect()}
    tagged = []
    for r in toxic:
        assert 0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        tagged += ["zzk" in texts[r.doc_id][s.start : s.end].lower() for s in r.spans]
    assert sum(tagged) >= 0.9 * len(tagged) and sum(tagged) >= 350
    good = quality.score_quality(docs, marks).collect()
    assert sum(r.predicted == truth[r.doc_id][0] for r in good if r.held_out) >= 0.95 * sum(r.held_out for r in good)
    kept = toxicity.drop_toxic(docs, marks)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in toxic if not r.predicted}


@pytest.mark.parametrize("name, column, least", [("op5_toxicity", "toxic", 0.85), ("op6_quality", "quality", 0.85)])
def test_held_out_accuracy(spark, name, column, least):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r[column] for r in read(spark, "labels", sf_dir).collect()}
    rows = [r for r in llm_queries()[name](spark, sf_dir).collect() if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in rows) >= least * len(rows)


def test_classifiers_take_odd_rows(spark):
    docs = odd_docs(spark)
    _, marks, _ = toy_labelled(spark)
    train, _, _ = toy_labelled(spark)
    for score, module in ((toxicity.score_toxicity, "toxic"), (quality.score_quality, "quality")):
        for given in (labels(spark), labels(spark, [(0, 1, 1), (0, 0, 0), (None, 1, 1)]), labels(spark, [(6, 1, 1)])):
            rows = score(docs, given).collect()
            assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows), module
        both = train.unionByName(docs.select("doc_id", "text"))
        assert len(score(both, marks).collect()) == 412
        assert score(no_docs(spark), marks).count() == 0
    assert toxicity.drop_toxic(docs, labels(spark)).count() == 12
    assert toxicity.drop_toxic(both, marks).columns == both.columns


def test_quality_compresses_all_blocks():
    assert b"".join(quality.blocks("é" * 1000)) == ("é" * 1000).encode()
    assert quality.blocks(None) == [b""]


def test_tree_marginals_match_enumeration():
    model = htmltext.Model({"tag p": 0.7, "tag div": -0.4, "name ad": -1.5, "text long plain": 0.9}, ((0.5, -0.7), (-0.2, 0.9)))
    page = "<div><p>a</p><div class=ad><p>" + "b " * 100 + "</p></div></div><p>c</p>"
    nodes, _ = htmltext.parse(page)
    own = [sum(model.weights.get(o, 0.0) for o in htmltext.observations(n)) for n in nodes]
    total = np.zeros((len(nodes), 2))
    for code in range(1 << len(nodes)):
        y = [code >> k & 1 for k in range(len(nodes))]
        score = sum(w for w, v in zip(own, y, strict=True) if v) + sum(model.joint[y[n.parent]][y[k]] for k, n in enumerate(nodes) if k)
        for k, v in enumerate(y):
            total[k, v] += np.exp(score)
    odds, _, _ = model.marginals(nodes)
    assert np.allclose(odds, total[:, 1] / total[:, 0])


def test_blocks_of_a_page():
    page = "<P>a <b>b</b>\n c&amp;d<p>e<br>f<ul><li>g<li>h</ul>i<script>x</script><!-- j --><style>k</style><table><tr><td>l<td>m</table><p>n&#233; <a href='>'>o"
    assert [t for _, t in htmltext.parse(page)[1]] == ["a b c&d", "e f", "g", "h", "i", "l", "m", "né o"]
    assert htmltext.parse("<" * 2000 + "a" * 10)[1] and htmltext.parse(None)[1] == [] and htmltext.parse("<div " * 500)[1] == []


def test_page_text_of_layouts(spark):
    model = htmltext.train([])
    article = "<h1>Title</h1><p>The river rose by two metres in a night, and the gauges showed it, the town said.</p><p>It fell.</p>"
    for wrap in ("<article>{}</article>", "<main>{}</main>", "<div class='post content'>{}</div>"):
        page = (
            "<html><head><title>t</title></head><body><header><p>Site</p></header><nav><ul><li><a href=/>Home</a></ul></nav>"
            "<div class='sidebar'><p>Some other story, told at length, with commas, and a full stop at its end.</p></div>"
            + wrap.format(article)
            + "<div id='comments'><p>I read this with joy, and I think so too, wrote a reader from afar.</p></div>"
            "<form><p>Subscribe</p></form><footer><p>Copyright</p></footer></body></html>"
        )
        got = htmltext.main_text(model, page)
        assert got == "Title\nThe river rose by two metres in a night, and the gauges showed it, the town said.\nIt fell."


STORY = ["Council votes on the harbour", "The vote was close, and it took the council two evenings to get that far, said its speaker.", "Work starts in May."]
BODY = "<h1>{}</h1><p>{}</p><p>{}</p>".format(*STORY)
NOISE = "We would like to tell you about something else entirely, which you may well find of interest."
LAYOUTS = [
    f"<article>{BODY}<div class='cookie-notice'><p>{NOISE}</p></div></article>",
    f"<article>{BODY}<form><p>{NOISE}</p></form></article>",
    f"<article>{BODY}<div class='paywall-box'><p>{NOISE}</p></div></article>",
    f"<article>{BODY}</article><article class='teaser'><p>{NOISE}</p></article>",
    f"<div role=navigation><p>{NOISE}</p></div><div role=main>{BODY}</div>",
    f"<div role=main>{BODY}</div><div role=contentinfo><p>{NOISE}</p></div>",
    f"<table><tr><td><ul><li><a href=/x>Home</a><li><a href=/y>Town</a></ul><td>{BODY}</table>",
    f"<main>{BODY}<aside><p>{NOISE}</p></aside></main>",
    f"<main><article>{BODY}</article><section id=comments><p>{NOISE}</p><p>{NOISE}</p></section></main>",
    f"<main>{BODY}<div class='newsletterSignup'><h3>Letter</h3><p>{NOISE}</p></div></main>",
    f"<div class=page-header><p>{NOISE}</p></div><div class=story-content>{BODY}</div><div id=site-footer><p>{NOISE}</p></div>",
    f"<article><header><p>{NOISE}</p></header>{BODY}<footer><p>{NOISE}</p></footer></article>",
    f"<article><div><div>{BODY}</div></div><nav><a href=/z>Next</a></nav></article>",
    f"<article>{BODY}<div class='ad-slot'><div><p>{NOISE}</p></div></div></article>",
    f"<article>{BODY}<ul class='share-links'><li>Send it on</li><li>Print it</li></ul></article>",
    f"<section class='article body'>{BODY}</section><section class='related-stories'><p>{NOISE}</p></section>",
    f"<div id=cookie-banner><p>{NOISE}</p><p>{NOISE}</p></div><article>{BODY}</article>",
    f"<article>{BODY}<div role=alert><p>{NOISE}</p></div></article>",
    f"<div role=dialog><p>{NOISE}</p></div><main>{BODY}</main>",
    f"<div role=banner><p>{NOISE}</p></div><div id=content>{BODY}</div>",
    f"<div id=content>{BODY}<div role=complementary><p>{NOISE}</p></div></div>",
    f"<main>{BODY}<div class='sponsored-content'><p>{NOISE}</p></div></main>",
    f"<main>{BODY}<div id='login-form'><p>{NOISE}</p></div></main>",
    f"<article>{BODY}<div class='comment-list'><div class=comment><p>{NOISE}</p></div></div></article>",
    f"<article>{BODY}<section class='promo'><h2>More</h2><p>{NOISE}</p></section></article>",
    f"<div class=sidebar-left><p>{NOISE}</p></div><article>{BODY}</article>",
    f"<main>{BODY}</main><div class=disclaimer><p>{NOISE}</p></div>",
    f"<main><div class=breadcrumb><p>Home, Town</p></div>{BODY}</main>",
    f"<article>{BODY}<p class=advertisement>{NOISE}</p></article>",
    f"<article>{BODY}<div class='gdpr consent'><p>{NOISE}</p><form><p>{NOISE}</p></form></div></article>",
]


def test_unseen_layouts(spark):
    rows = read(spark, "pages").orderBy("page_id").limit(htmltext.TRAIN_PAGES).collect()
    model = htmltext.train([r.html for r in rows])
    wrong = [(k, t) for k, page in enumerate(LAYOUTS) if (t := htmltext.main_text(model, f"<html><body>{page}</body></html>")) != "\n".join(STORY)]
    assert wrong == []


def test_pages_query(spark):
    pages = {r.page_id: r for r in read(spark, "pages").collect()}
    rows = llm_queries()["op7_html_text"](spark, SF_DIR).collect()
    assert len(rows) == len(pages)
    for r in rows:
        html = pages[r.page_id].html
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", html, re.S)[1]
        blocks = [" ".join(htmltext.html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_pages_with_nothing(spark):
    schema = "page_id long, url string, html string, text string"
    rows = spark.createDataFrame([(1, "u", None, "x"), (None, None, "", "x"), (2, "u", "<p>ok", "x"), (2, "u", "<p>ok", "x")], schema)
    assert sorted((r.text, r.n_chars) for r in htmltext.extract(rows).collect())[:2] == [("", 0), ("", 0)]
    assert htmltext.extract(rows.limit(0)).count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                found.append((m.start(), k, m.end(), kind))
    return [f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found)]


ODD = [
    "a@b.co_x@y.z", "..@@a@b.c.d", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.3.4 1.2.3", "+1 (017) 555-7713 x +49 30 123456789-", "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111-",
    "é 4111111111111111 🙂 ü@x.de a@ b@c", "", None, "1 2 3 4 5 6 7 8 9 0 1 2 3", "+1+1 (23) 4567890", "5 " * 40, "127.0.0.1.", "x" * 3000 + "@a.b " + "9" * 3000, "a@b.c" * 5,
]


def test_base_spans(spark):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("0123456789.@ab+- ()") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in sanitise.report(docs).collect():
        want = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("term")] == want
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k in PLAIN]


def test_terms_that_disclose(spark):
    rng = random.Random(2)
    texts = [f"{sentence(rng, 20)} Write to Quillfeather, at q@corp.example {sentence(rng, 20)}" for _ in range(5)]
    texts += [sentence(rng, 30) + " write to us at the desk" for _ in range(200)]
    docs = spark.createDataFrame([(i, t, "t") for i, t in enumerate(texts)], "doc_id long, text string, terms string").coalesce(2)
    rows = {r.doc_id: r for r in sanitise.report(docs).collect()}
    for i in range(5):
        marked = [texts[i][int(s.split(":")[1]) : int(s.split(":")[2])] for s in rows[i].spans.split(",") if s.startswith("term")]
        assert marked == ["Quillfeather"]
    assert all(not rows[i].spans for i in range(5, len(texts)))
    clean = sanitise.sanitise(docs)
    assert clean.columns == docs.columns
    for r in clean.collect():
        if r.doc_id < 5:
            assert "q@corp" not in r.text and "Quillfeather" not in r.text and "Write to , at [EMAIL]" in r.text
        else:
            assert r.text == texts[r.doc_id]


def plain_terms(texts):
    """Term spans of every text, from counts over all pairs of entity and term."""
    entities, words = [], []
    for text in texts:
        own = set()
        for span in plain_spans(text):
            kind, start, end = span.split(":")
            value = text[int(start) : int(end)]
            own.add((kind, value.lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", value)))
        entities.append(own)
        places = []
        for part in regex.finditer(r"[^\x20\x09-\x0D]+", text or ""):
            bare = regex.sub(r"^[^\p{L}]+|[^\p{L}]+$", "", part[0])
            if regex.fullmatch(r"\p{L}[\p{L}'’-]{2,}", bare):
                start = part.start() + len(part[0]) - len(regex.sub(r"^[^\p{L}]+", "", part[0]))
                places.append((bare.lower(), start, start + len(bare)))
        words.append(places)
    n = len(texts)
    n_entity = Counter(e for own in entities for e in own)
    n_term = Counter(t for places in words for t in {p[0] for p in places})
    both = Counter((e, t) for own, places in zip(entities, words, strict=True) for e in own for t in {p[0] for p in places})

    def discloses(e, t):
        content = math.log2(n / n_entity[e])
        return both[e, t] >= 3 and content > 0 and math.log2(both[e, t] * n / (n_entity[e] * n_term[t])) >= 0.9 * content - 1e-12

    return [{(s, f) for t, s, f in places if any(discloses(e, t) for e in own)} for own, places in zip(entities, words, strict=True)]


def check_terms(found, texts):
    for i, want in enumerate(plain_terms(texts)):
        marked = {tuple(map(int, s.split(":")[1:])) for s in found[i].split(",") if s.startswith("term")}
        assert marked == want


def test_terms_count_over_whole_texts(spark):
    rng = random.Random(9)
    far = lambda: sentence(rng, 60)
    # A name again further on, a name found only far off, and one before another number.
    texts = [f"{far()} q2@corp.example {far()} (Featherstone) {far()} featherstone, {far()}" for _ in range(4)]
    texts += [f"{far()} Quillhaven {far()} q@corp.example {far()}" for _ in range(4)]
    texts += [f"{far()} Stonebridge 12 at 4111 1111 1111 1111 {far()}" for _ in range(4)]
    # An entity in a third of all texts, one in all of its copies, several in one text.
    texts += [f"footer@corp.example {sentence(rng, 10)} Hotword" for _ in range(40)] + ["copy of Marblewood, call +1 202 555 0147 now"] * 9
    texts += [f"q@corp.example q2@corp.example {far()}", None, "", "Featherstone"] + [sentence(rng, 40) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.spans for r in sanitise.report(docs).collect()}
    check_terms(found, texts)
    names = [{texts[i][int(s.split(":")[1]) : int(s.split(":")[2])] for s in found[i].split(",") if s.startswith("term")} for i in range(12)]
    assert all("Featherstone" in n and "featherstone" in n for n in names[:4])
    assert all("Quillhaven" in n for n in names[4:8]) and all("Stonebridge" in n for n in names[8:])
    clean = {r.doc_id: r.text for r in sanitise.sanitise(docs).collect()}
    assert all("eatherstone" not in clean[i] for i in range(4)) and clean[len(texts) - 61] == "Featherstone"


def test_terms_of_the_documents(spark):
    texts = [r.text for r in read(spark, "documents").orderBy("doc_id").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    check_terms({r.doc_id: r.spans for r in sanitise.report(docs).collect()}, texts)


def test_sanitise_odd_rows(spark):
    docs = odd_docs(spark)
    assert sorted(map(str, docs.collect())) == sorted(map(str, sanitise.sanitise(docs).collect()))
    assert sanitise.report(docs).count() == 12
    assert sanitise.report(no_docs(spark)).count() == 0 and sanitise.sanitise(no_docs(spark)).count() == 0


def test_personal_data_query(spark):
    docs = {r.doc_id: r.text for r in read(spark, "documents").collect()}
    for r in llm_queries()["op8_personal_data"](spark, SF_DIR).collect():
        assert r.base_sha256 == hashlib.sha256(",".join(plain_spans(docs[r.doc_id])).encode()).hexdigest()
