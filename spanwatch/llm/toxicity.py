"""Toxic spans and document scores by a linear-chain conditional random field.

The labels say which documents are toxic, not which tokens. Token labels come from
them: a token of a toxic text is marked if its form, or a beginning of it, is found
far more often in toxic than in clean texts of the sample. On these tokens a field
with two states is trained by gradient ascent on its likelihood. Its observations
are the form and its beginnings; its transitions join neighbours. Forward-backward
gives each token's marginal; their sum and largest values, calibrated on whole
documents, are the score, and runs of tokens above one half are the spans.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.labelled import Logistic, held_out, sample

PER_CLASS = 1000
THRESHOLD = 0.3
STARTS = (3, 4, 5, 6)
LEAST_TEXTS = 3
MOST_CACHED = 1 << 18
SLICE = 1 << 16
_TOKEN = re.compile(r"[^\W_]+")


def forms(token: str) -> list[str]:
    """Observations of a token: its lower-case form and its beginnings."""
    low = token.lower()
    return ["=" + low, *["^" + low[:n] for n in STARTS if len(low) > n]]


def _products(steps: np.ndarray) -> np.ndarray:
    """Row vectors (1, 1) pushed through 2x2 matrices: shape (n, 2), each normed.

    The chain is cut into pieces of equal length that are walked side by side: first
    the product of each piece, then the vector at each piece's start, then the
    vectors inside.
    """
    n = len(steps)
    length = max(1, int(np.sqrt(n)))
    pieces = -(-n // length)
    padded = np.empty((pieces * length, 2, 2))
    padded[:n] = steps
    padded[n:] = np.eye(2)
    cut = padded.reshape(pieces, length, 4).transpose(1, 2, 0).copy()
    p, q, r, s = np.ones(pieces), np.zeros(pieces), np.zeros(pieces), np.ones(pieces)
    for a, b, c, d in cut:
        p, q, r, s = p * a + q * c, p * b + q * d, r * a + s * c, r * b + s * d
        top = np.maximum(np.maximum(p, q), np.maximum(r, s))
        p, q, r, s = p / top, q / top, r / top, s / top
    x, y = np.empty(pieces), np.empty(pieces)
    u, v = 0.5, 0.5
    for k, (a, b, c, d) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist(), strict=True)):
        x[k], y[k] = u, v
        u, v = u * a + v * c, u * b + v * d
        u, v = u / (u + v), v / (u + v)
    out = np.empty((length, 2, pieces))
    for k, (a, b, c, d) in enumerate(cut):
        x, y = x * a + y * c, x * b + y * d
        total = x + y
        x, y = x / total, y / total
        out[k, 0], out[k, 1] = x, y
    return out.transpose(2, 0, 1).reshape(-1, 2)[:n]


def forward_backward(odds: np.ndarray, first: np.ndarray, enter: float, leave: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of state 1, and the vectors before and behind each token.

    ``odds``: weight of state 1 against state 0 at each token; ``first``: where a
    text begins; ``enter``, ``leave``: log weights of 0 to 1 and 1 to 0, against
    staying. Texts stand one after the other and do not influence each other.
    """
    n = len(odds)
    lift = np.exp(np.clip(odds, -30, 30))
    step = np.empty((n, 2, 2))
    step[:, 0, 0] = 1.0
    step[:, 0, 1] = np.exp(enter) * lift
    # Both rows are equal where a text begins, so nothing is carried over.
    step[:, 1, 0] = np.where(first, 1.0, np.exp(leave))
    step[:, 1, 1] = np.where(first, np.exp(enter) * lift, lift)
    ahead = _products(step)
    # The vector behind token t comes from the matrices after it, last one first.
    back = np.full((n, 2), 0.5)
    if n > 1:
        back[: n - 1] = _products(step[:0:-1].transpose(0, 2, 1))[::-1]
    one, zero = ahead[:, 1] * back[:, 1], ahead[:, 0] * back[:, 0]
    return one / (one + zero), ahead, back


def expected_moves(odds, first, enter, leave, ahead, back) -> tuple[float, float]:
    """Expected steps from 0 to 1 and from 1 to 0 inside the texts."""
    lift = np.exp(np.clip(odds[1:], -30, 30))
    up = ahead[:-1, 0] * np.exp(enter) * lift * back[1:, 1]
    down = ahead[:-1, 1] * np.exp(leave) * back[1:, 0]
    stay = ahead[:-1, 0] * back[1:, 0] + ahead[:-1, 1] * lift * back[1:, 1]
    total = up + down + stay
    inside = ~first[1:]
    return float((up / total)[inside].sum()), float((down / total)[inside].sum())


@dataclass
class Tagger:
    """Weights by observation; ``calibrate`` is None without labels of both classes."""

    weights: dict[str, float] = field(default_factory=dict)
    base: float = 0.0
    enter: float = 0.0
    leave: float = 0.0
    calibrate: Logistic | None = None
    prior: float = 0.5

    def odds(self, token: str) -> float:
        get = self.weights.get
        return self.base + sum(get(f, 0.0) for f in forms(token))

    def marginals(self, texts: list[list[str]], cache: dict[str, float]) -> list[np.ndarray]:
        """Marginals of each text's tokens; texts are joined into slices for speed."""
        lengths = [len(t) for t in texts]
        odds = np.empty(sum(lengths))
        at = 0
        for tokens in texts:
            if len(cache) > MOST_CACHED:
                cache.clear()
            for token in set(tokens).difference(cache):
                cache[token] = self.odds(token)
            odds[at : at + len(tokens)] = [cache[t] for t in tokens]
            at += len(tokens)
        if not len(odds):
            return [np.zeros(0) for _ in texts]
        starts = np.cumsum([0, *lengths])
        first = np.zeros(len(odds), bool)
        first[[s for s, n in zip(starts, lengths, strict=False) if n]] = True
        marginal, _, _ = forward_backward(odds, first, self.enter, self.leave)
        return [marginal[s : s + n] for s, n in zip(starts, lengths, strict=False)]

    def read(self, texts: list[str | None], cache: dict[str, float]) -> Iterator[tuple[str, list[str], np.ndarray]]:
        """Text, tokens and marginals, a slice of about ``SLICE`` tokens at a time."""
        group, held = [], 0
        for text in texts:
            group.append((text or "", _TOKEN.findall(text or "")))
            held += len(group[-1][1])
            if held >= SLICE:
                yield from self._flush(group, cache)
                group, held = [], 0
        yield from self._flush(group, cache)

    def _flush(self, group, cache):
        for (text, tokens), marginal in zip(group, self.marginals([t for _, t in group], cache), strict=True):
            yield text, tokens, marginal


def summary(marginal: np.ndarray) -> tuple[float, float, float]:
    """What the calibration sees of one text."""
    if not len(marginal):
        return 0.0, 0.0, 0.0
    top = np.sort(marginal)[-3:]
    return float(top[-1]), float(top.mean()), float(np.log1p(marginal[marginal > 0.05].sum()))


def spans(text: str, marginal: np.ndarray) -> list[dict]:
    """Runs of tokens above one half, as code point offsets."""
    found: list[dict] = []
    if not (marginal > 0.5).any():
        return found
    last = -2
    for k, match in enumerate(_TOKEN.finditer(text)):
        if marginal[k] > 0.5:
            if last == k - 1 and found:
                found[-1]["end"] = match.end()
                found[-1]["score"] = max(found[-1]["score"], float(marginal[k]))
            else:
                found.append({"start": match.start(), "end": match.end(), "score": float(marginal[k])})
            last = k
    return found


def _counted(rows: list[tuple[str, int]]) -> tuple[Counter, Counter]:
    """In how many toxic and clean texts an observation is found; only observations of
    ``LEAST_TEXTS`` toxic texts are counted."""
    toxic, clean = Counter(), Counter()

    def distinct(text: str) -> set[str]:
        return {f for t in set(_TOKEN.findall(text)) for f in forms(t)}

    for text, c in rows:
        if c:
            toxic.update(distinct(text))
    toxic = Counter({f: n for f, n in toxic.items() if n >= LEAST_TEXTS})
    for text, c in rows:
        if not c:
            clean.update(f for f in distinct(text) if f in toxic)
    return toxic, clean


def train(rows: list[tuple[str, int]], rounds: int = 40, rate: float = 1.0, ridge: float = 0.05) -> Tagger:
    """Fit the field on the tokens of the sample, then the calibration on its texts.

    Texts are gone through in slices, so memory holds token numbers and one slice.
    """
    y = np.array([c for _, c in rows], float)
    tagger = Tagger(prior=float(y.mean()) if len(y) else 0.5)
    if len(set(y.tolist())) < 2:
        return tagger
    toxic, clean = _counted(rows)
    n1, n0 = y.sum(), len(y) - y.sum()
    # Rate in toxic texts at least ten times that in clean ones, with half a text of doubt.
    marks = {f for f, n in toxic.items() if n / n1 >= 10 * (clean[f] + 0.5) / n0 and n >= 8 * (clean[f] * n1 / n0 + 0.25)}
    words: dict[str, int] = {}
    texts = [np.array([words.setdefault(t, len(words)) for t in _TOKEN.findall(text)], np.int32) for text, _ in rows]
    names = {f: i for i, f in enumerate(toxic)}
    pairs = np.array([(i, names[f]) for w, i in words.items() for f in forms(w) if f in names], np.int64).reshape(-1, 2)
    marked = np.array([any(f in marks for f in forms(w)) for w in words], bool)

    slices: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    group, held = [], 0
    for k, ids in enumerate(texts):
        group.append(k)
        held += len(ids)
        if held >= SLICE or k == len(texts) - 1:
            joined = np.concatenate([texts[g] for g in group])
            first = np.zeros(len(joined), bool)
            first[[s for s, g in zip(np.cumsum([0, *(len(texts[g]) for g in group)]), group, strict=False) if len(texts[g])]] = True
            truth = marked[joined] & np.repeat([y[g] > 0 for g in group], [len(texts[g]) for g in group])
            if len(joined):
                slices.append((joined, first, truth.astype(float)))
            group, held = [], 0
    if not slices:
        return tagger
    enters = leaves = share = 0.0
    for _, first, truth in slices:
        before = np.where(first, 0.0, np.concatenate(([0.0], truth[:-1])))
        enters += float((truth * (1 - before)).sum())
        leaves += float(((1 - truth) * before).sum())
        share += float(truth.sum())
    share = max(share, 1.0)

    theta, base, enter, leave = np.zeros(len(names)), 0.0, -2.0, 0.0
    squares, others = np.full(len(names), 1e-6), np.full(3, 1e-6)
    for _ in range(rounds):
        per_word = base + np.bincount(pairs[:, 0], theta[pairs[:, 1]], len(words))
        off, rest = np.zeros(len(words)), np.array([0.0, enters, leaves])
        for ids, first, truth in slices:
            odds = per_word[ids]
            marginal, ahead, back = forward_backward(odds, first, enter, leave)
            up, down = expected_moves(odds, first, enter, leave, ahead, back)
            off += np.bincount(ids, truth - marginal, len(words))
            rest -= [(marginal - truth).sum(), up + marginal[first].sum(), down]
        slope = np.bincount(pairs[:, 1], off[pairs[:, 0]], len(names)) / share - ridge * theta * 0.01
        squares += slope**2
        theta += rate * slope / np.sqrt(squares)
        rest /= share
        others += rest**2
        base, enter, leave = np.array([base, enter, leave]) + rate * rest / np.sqrt(others)
    tagger.base, tagger.enter, tagger.leave = float(base), float(enter), float(leave)
    tagger.weights = {f: float(theta[i]) for f, i in names.items() if abs(theta[i]) > 1e-3}
    per_word = np.array([tagger.odds(w) for w in words])
    features = []
    for ids in texts:
        first = np.zeros(len(ids), bool)
        first[:1] = True
        features.append(summary(forward_backward(per_word[ids], first, tagger.enter, tagger.leave)[0] if len(ids) else np.zeros(0)))
    tagger.calibrate = Logistic(np.array(features), y)
    return tagger


def trained(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Tagger:
    """The tagger fitted on the labelled texts that are not held out."""
    return train(sample(docs, labels, "toxic", per_class, 4, 2))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns as they
    were. Rows are judged one by one, so null and repeated ids need no care. Without
    labels of both classes nothing is dropped."""
    tagger = trained(docs, labels, per_class)
    if tagger.calibrate is None:
        return docs
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        for batch in batches:
            features = [summary(m) for _, _, m in tagger.read(batch.column(place).to_pylist(), cache)]
            yield batch.filter(pa.array(tagger.calibrate(np.array(features).reshape(-1, 3)) < threshold))

    return docs.mapInArrow(run, docs.schema)


SPANS = "array<struct<start:int,end:int,score:double>>"


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``held_out``, ``score`` (0 to 1),
    ``predicted`` and ``spans`` (start, end in code points, best marginal).

    Learns from at most ``per_class`` texts of each label whose crc32(doc_id) mod 4
    is not 2. Only the text is an input of a score; null counts as empty. Without
    labels of both classes every score is the share of toxic labels (0.5 if none).
    """
    tagger = trained(docs, labels, per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            features, found = [], []
            for text, _, marginal in tagger.read(batch.column(1).to_pylist(), cache):
                features.append(summary(marginal))
                found.append(spans(text, marginal))
            if tagger.calibrate is None:
                score = np.full(batch.num_rows, tagger.prior)
            else:
                score = tagger.calibrate(np.array(features).reshape(-1, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array(found, kinds)], ["doc_id", "score", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, spans {SPANS}")
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "spans"
    )
