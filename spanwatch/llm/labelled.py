"""Bounded samples of labelled texts, the held-out rule, and calibration of scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return (F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % modulus).cast("int")


def held_out(id_column: Column, modulus: int, left: int) -> Column:
    return remainder(id_column, modulus) == left


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, modulus: int, left: int) -> list[tuple[str, int]]:
    """At most ``per_class`` texts of each class that are not held out, and their class.

    Ids are chosen among the labels by a hash, so the sample is the same on every
    run; ids with null or contradicting labels are left out. The chosen ids, at most
    twice ``per_class``, are the side that is broadcast.
    """
    clear = labels.select("doc_id", F.col(label).alias("y")).filter("doc_id is not null and y in (0, 1)")
    clear = clear.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).filter("y = other")
    usable = clear.filter(~held_out(F.col("doc_id"), modulus, left))
    order = F.xxhash64(F.lit(label), F.col("doc_id"))
    chosen = None
    for value in (0, 1):
        part = usable.filter(F.col("y") == value).orderBy(order, "doc_id").limit(per_class).select("doc_id", "y")
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select("doc_id", "text").filter("text is not null")
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    rows = found.collect()
    return [(r.text, int(r.y)) for r in sorted(rows, key=lambda r: r.doc_id)]


class Logistic:
    """Ridge logistic regression on a few standardised features (Newton steps)."""

    def __init__(self, features: np.ndarray, classes: np.ndarray, ridge: float = 1.0) -> None:
        self.mean = features.mean(axis=0)
        self.scale = np.where(features.std(axis=0) > 1e-12, features.std(axis=0), 1.0)
        x = self._ready(features)
        self.weights = np.zeros(x.shape[1])
        keep = np.full(x.shape[1], ridge)
        keep[0] = 1e-6
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
            slope = x.T @ (p - classes) + keep * self.weights
            curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep)
            step = np.linalg.solve(curve, slope)
            self.weights -= step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-8:
                break

    def _ready(self, features: np.ndarray) -> np.ndarray:
        x = np.clip((features - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.ones((len(x), 1)), x], axis=1)

    def __call__(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._ready(features) @ self.weights, -30, 30)))
