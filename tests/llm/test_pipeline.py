"""Every stage acts on what the one before it kept, and the mix comes out of the last."""

import itertools
import random

import corpus_pipeline
import pytest
from corpus import SF_DIR, components, labels, no_docs, odd_docs, odd_texts, read, sentence

from spanwatch.llm import decontaminate, simhash
from spanwatch.llm.scratch import stored


def first_of_copies(rows):
    """Smallest id of every group of fingerprints within four bits, by all pairs."""
    prints = {r.doc_id: simhash.fingerprint(r.text) for r in rows}
    linked = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    return set(components(prints, linked).values())


def test_copies_of_all_kinds(spark):
    rng = random.Random(21)
    rows = []
    for size in (3, 9, 40, 700):
        for _ in range(6):
            words = sentence(rng, size).split()
            for edits in (0, 0, 1, 3):
                changed = words.copy()
                for _ in range(edits):
                    changed[rng.randrange(size)] = sentence(rng, 1)
                rows.append((len(rows), " ".join(changed), "x", len(rows)))
    rows += [(len(rows), None, "x", 1), (len(rows) + 1, " ", "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, row int").coalesce(1)
    kept = simhash.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first_of_copies(docs.collect()))


def test_stages_and_run(spark):
    docs = read(spark, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, SF_DIR), name)
        assert after.columns == columns and 0 < after.count() <= docs.count()
        if name != "personal_data":
            assert after.exceptAll(docs).count() == 0
        if name == "near_copies":
            assert {r.doc_id for r in after.collect()} == first_of_copies(docs.collect())
        if name == "benchmark":
            assert decontaminate.contaminated(after, read(spark, "benchmark")).count() == 0
        docs = after
    mix = corpus_pipeline.mix_sources(spark, docs, SF_DIR).collect()
    words = sum(r.mix_taken for r in mix)
    assert 0.8 < words / (1.5 * sum(len(r.text.split()) for r in docs.collect())) < 1.2
    # Run anew, the stages give the same rows.
    again = corpus_pipeline.run(spark, SF_DIR)
    assert again.columns[: len(columns)] == columns
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, mix), key=repr)


@pytest.mark.parametrize("make", [odd_docs, no_docs])
def test_odd_tables(spark, tmp_path, make):
    make(spark).write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark, [(6, 1, 0)]).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "an item that no one has")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # One of each text; those without words have nothing to take.
    texts = [r.text for r in found]
    worded = {t for t in odd_texts() if t and t.split()}
    assert len(texts) == len(set(texts)) and {t for t in texts if t and t.split()} <= worded
    assert (sum(r.mix_taken for r in found) > 0) == (make is odd_docs)


def test_query_names():
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in __spark_entry__.queries()
