"""Small corpora with nulls, empty and long texts, ties, repeated rows and extra columns."""

import random

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def odd_texts():
    """Texts that every operator has to take."""
    rng = random.Random(1)
    long = sentence(rng, 4000)
    return [None, "", " \t\n", "one", "two words", "ü ñ 中文 🙂 é", long, long, "same text here", "same text here", "x" * 5000, "a\u0000b �"]


def odd_docs(spark, texts=None):
    """The texts as documents with null and repeated ids, null sources and columns whose
    names operators use inside."""
    texts = odd_texts() if texts is None else texts
    rows = [(None if i == 3 else (7 if i in (8, 9) else i), t, None, None if i % 4 == 0 else f"s{i % 3}", None, "keep", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS + ", score string, row int").coalesce(1)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def read(spark, name, sf_dir=SF_DIR):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(ids, linked):
    """Smallest id reachable, by comparing all pairs."""
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
