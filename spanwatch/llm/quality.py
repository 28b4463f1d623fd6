"""Quality classifier by compression.

Two zstandard dictionaries are trained, one from texts labelled good and one from
texts labelled bad. A text is cut into blocks, all of them are compressed against
both, and the normalised difference of the compressed sizes is calibrated to a
probability. How far the blocks shrink at all is a second input of the calibration:
a text that repeats a few words shrinks alike against either dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.labelled import Logistic, held_out, sample

PER_CLASS = 1500
DICTIONARY = 65536
BLOCK = 512
LEVEL = 3
THRESHOLD = 0.3


def blocks(text: str | None, size: int = BLOCK) -> list[bytes]:
    """The whole text in blocks of ``size`` bytes; one empty block for an empty text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return [data[i : i + size] for i in range(0, len(data), size)] or [b""]


def dictionary(texts: list[str], size: int = DICTIONARY) -> bytes:
    """A trained dictionary, or the texts themselves where there are too few to train."""
    pieces = list(dict.fromkeys(b for t in texts for b in blocks(t)))
    try:
        return zstandard.train_dictionary(size, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-size:]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content), write_content_size=False, write_checksum=False, write_dict_id=False
    )


@dataclass
class Model:
    """Both dictionaries and the calibration; ``calibrate`` is None without labels of both classes."""

    good: bytes
    bad: bytes
    calibrate: Logistic | None
    prior: float

    def measure(self, texts: list[str | None]) -> np.ndarray:
        good, bad = compressor(self.good), compressor(self.bad)
        rows = []
        for text in texts:
            parts = blocks(text)
            sizes = np.array([(len(good.compress(b)), len(bad.compress(b)), len(b)) for b in parts], float)
            g, b, n = sizes.T
            difference = (g - b) / (g + b)
            shrunk = np.minimum(g, b) / (n + 16.0)
            total = sizes.sum(axis=0)
            rows.append(
                (
                    (total[0] - total[1]) / (total[0] + total[1]),
                    difference.max(),
                    difference.min(),
                    min(total[0], total[1]) / (total[2] + 16.0),
                    np.log(min(total[0], total[1]) / (total[2] + 16.0) + 0.01),
                    shrunk.min(),
                    1.0 / np.sqrt(total[2] + 16.0),
                )
            )
        return np.array(rows).reshape(len(texts), 7)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.calibrate is None:
            return np.full(len(texts), self.prior)
        return self.calibrate(self.measure(texts))


def train(rows: list[tuple[str, int]]) -> Model:
    """Dictionaries from two thirds of the rows; the rest, unseen by them, calibrates."""
    y = np.array([c for _, c in rows], float)
    prior = float(y.mean()) if len(y) else 0.5
    if len(set(y.tolist())) < 2:
        return Model(b"", b"", None, prior)
    fit = [r for i, r in enumerate(rows) if i % 3]
    model = Model(dictionary([t for t, c in fit if c == 1]), dictionary([t for t, c in fit if c == 0]), None, prior)
    rest = [r for i, r in enumerate(rows) if i % 3 == 0]
    if len({c for _, c in rest}) == 2:
        model.calibrate = Logistic(model.measure([t for t, _ in rest]), np.array([c for _, c in rest], float))
    return model


def score_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Every row of ``docs`` with ``held_out``, ``score`` (0 to 1) and ``predicted``.

    Learns from at most ``per_class`` texts of each label whose crc32(doc_id) mod 5
    is not 0. Only the text is an input of a score; null counts as empty. Without
    labels of both classes every score is the share of good labels (0.5 if none).
    """
    model = train(sample(docs, labels, "quality", per_class, 5, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
