"""Text quality by naive Bayes support vectors.

Features are indicators of byte n-grams, and of how far the word n-grams of a text repeat. Each is scaled by the ratio of its class log-counts;
a linear hinge-loss model is fitted to the scaled indicators by dual coordinate descent. Its
decision values are mapped to probabilities by a sigmoid fitted out of sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.labelled import labelled_sample
from quern.session import ship_package

BITS = 16


@dataclass(frozen=True)
class NbsvmSetup:
    """Bound of the labelled sample, smoothing, penalty and passes of the descent."""

    sample_rows: int = 6000
    smoothing: float = 1.0
    penalty: float = 1.0
    passes: int = 12


def indicators(text: str | None) -> np.ndarray:
    """Buckets of the n-grams that a text has, in ascending order.

    These are its byte n-grams (one to three bytes) and marks of the shares of its words, word
    pairs and lines that are repeats of earlier ones. The whole text counts. A NULL or empty
    text has none.
    """
    whole = (text or "").encode("utf-8", "surrogatepass")
    raw = np.frombuffer(whole, np.uint8).astype(np.uint32)
    seen = np.zeros(1 << BITS, bool)
    words = whole.split()
    if words:
        pairs = list(zip(words, words[1:], strict=False))
        lines = whole.split(b"\n")
        for kind, parts in enumerate((words, pairs, lines)):
            share = 1 - len(set(parts)) / len(parts) if parts else 0.0
            # One mark for each tenth reached, so that a larger share has all marks of a smaller one.
            seen[kind * 16 : kind * 16 + int(share * 10) + 1] = True
        again = sum(map(bytes.__eq__, words, words[1:]))
        seen[48 : 49 + int(10 * again / len(words))] = True
        seen[64 : 64 + len(words).bit_length()] = True
    if raw.size:
        seen[_bucket(raw)] = True
        pairs = raw[:-1] << 8 | raw[1:] | 1 << 24
        seen[_bucket(pairs)] = True
        seen[_bucket((pairs[:-1] & 0xFFFF) << 8 | raw[2:] | 2 << 24)] = True
    return np.flatnonzero(seen).astype(np.int32)


def _bucket(code: np.ndarray) -> np.ndarray:
    """A bucket above the first 128, which are the marks."""
    return np.maximum((code * np.uint32(2654435761)) >> np.uint32(32 - BITS), np.uint32(128))


def dual_coordinate_descent(
    rows: list[np.ndarray], signs: np.ndarray, scale: np.ndarray, setup: NbsvmSetup
) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge-loss model.

    Row i has the values ``scale[rows[i]]``, brought to length one; one dual variable per row
    is optimised at a time, in an order drawn from a fixed seed, and kept within the penalty.
    """
    weights, bias = np.zeros(scale.size), 0.0
    alpha = np.zeros(len(rows))
    values = []
    for idx in rows:
        v = scale[idx]
        norm = float(np.sqrt(v @ v))
        values.append(v / norm if norm else v)
    curvature = np.array([float(v @ v) + 1.0 for v in values])
    random = np.random.default_rng(7)
    for _ in range(setup.passes):
        for i in random.permutation(len(rows)):
            idx, v, y = rows[i], values[i], signs[i]
            gradient = y * (weights[idx] @ v + bias) - 1.0
            new = min(max(alpha[i] - gradient / curvature[i], 0.0), setup.penalty)
            if new != alpha[i]:
                step = (new - alpha[i]) * y
                weights[idx] += step * v
                bias += step
                alpha[i] = new
    return weights, bias


def _log_count_ratios(rows: list[np.ndarray], positive: np.ndarray, smoothing: float) -> np.ndarray:
    counts = np.full((2, 1 << BITS), smoothing)
    for idx, p in zip(rows, positive, strict=True):
        counts[int(p), idx] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def _sigmoid_fit(values: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the sigmoid of greatest likelihood, by damped Newton steps."""
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * values + b, -30, 30)))
        g = np.array([(values * (p - target)).sum(), (p - target).sum()])
        w = p * (1 - p)
        h = np.array([[(w * values * values).sum() + 1e-3, (w * values).sum()], [(w * values).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


@dataclass(frozen=True)
class QualityModel:
    """Scaled weights, bias and sigmoid; without two classes a constant score."""

    weights: np.ndarray
    scale: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, text: str | None) -> float:
        """Probability of label 1, for any text."""
        idx = indicators(text)
        v = self.scale[idx]
        norm = float(np.sqrt(v @ v))
        value = float(self.weights[idx] @ v) / norm + self.bias if norm else self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * value + self.offset, -30, 30))))


def fit(rows: list[np.ndarray], labels: np.ndarray, setup: NbsvmSetup = NbsvmSetup()) -> QualityModel:
    """A model of indicator rows and 0/1 labels; with one class or none a constant share."""
    positive = labels.astype(bool)
    if positive.all() or not positive.any():
        share = (positive.sum() + 1) / (positive.size + 2)
        none = np.zeros(1 << BITS)
        return QualityModel(none, none, 0.0, 1.0, float(np.log(share / (1 - share))))

    def trained(at: np.ndarray) -> QualityModel:
        part = [rows[i] for i in at]
        scale = _log_count_ratios(part, positive[at], setup.smoothing)
        weights, bias = dual_coordinate_descent(part, np.where(positive[at], 1.0, -1.0), scale, setup)
        return QualityModel(weights, scale, bias, 1.0, 0.0)

    order = np.random.default_rng(11).permutation(len(rows))
    values = np.zeros(len(rows))
    for fold in range(3):
        model = trained(order[np.arange(len(rows)) % 3 != fold])
        for i in order[np.arange(len(rows)) % 3 == fold]:
            v = model.scale[rows[i]]
            values[i] = float(model.weights[rows[i]] @ v) / (float(np.sqrt(v @ v)) or 1.0) + model.bias
    slope, offset = _sigmoid_fit(values, positive)
    final = trained(np.arange(len(rows)))
    return QualityModel(final.weights, final.scale, final.bias, slope, offset)


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    parts: int = 4,
    held_out: int = 2,
    setup: NbsvmSetup = NbsvmSetup(),
) -> QualityModel:
    """A model of at most about ``sample_rows`` labelled documents that are not held out.

    The workers turn texts into indicators; only those of the bounded sample are gathered.
    """
    ship_package(docs.sparkSession)
    sample = labelled_sample(docs, labels, key, text, label, parts, held_out, setup.sample_rows)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "grams": [indicators(t).astype("<i4").tobytes() for t in batch["text"]]})

    found = sample.mapInPandas(encode, "label int, grams binary").collect()
    found.sort(key=lambda r: (bytes(r.grams), r.label))  # the same model however rows arrive
    return fit([np.frombuffer(r.grams, "<i4") for r in found], np.array([r.label for r in found], int), setup)


def score_quality(docs: DataFrame, model: QualityModel, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """``keep`` and the model's probability of label 1 for every whole text.

    NULL and empty texts get the score of a text without n-grams; repeated rows are scored
    each; an empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shared.value.score(t) for t in batch], dtype="float64")

    return docs.select(*keep, probability(F.col(text)).alias(name))
