"""Quality classifier: naive Bayes support vectors.

Indicators of byte n-grams, and of word n-grams of one repeated word, are scaled by the log-count ratio of the two classes; a linear
model with hinge loss is fitted on them by dual coordinate descent. Fitting uses a bounded
sample of labelled rows; scoring reads every whole text and is a map without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fold_remainder, slices, text_of

# The most labelled rows that are fitted. The driver holds their indicators, some 10 kB each.
SAMPLE_ROWS = 6000
TRIGRAM_BITS = 16
# Word n-grams of one repeated word, by n; real prose has hardly any.
REPEATS = (2, 3, 5)
HASHED = 256 + 65536 + (1 << TRIGRAM_BITS)
FEATURES = HASHED + len(REPEATS)
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
MIX = 0.75  # weight of the fitted model against its mean magnitude


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """doc_id, text and label of at most ``rows`` training documents, chosen by hash.

    Training documents are those whose crc32(doc_id as text) mod 3 is not 1. Rows without
    a label are left out; of several labels of one document the larger counts.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                          & (fold_remainder(F.col("doc_id"), 3) != 1)).groupBy("doc_id").agg(
        F.max(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # At most `rows` rows of two numbers.
    return docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")


class Indicators:
    """Distinct byte 1-, 2- and 3-grams and repeated words of a text as feature numbers."""

    def __init__(self) -> None:
        self._seen = np.zeros(FEATURES, bool)

    def __call__(self, text: str) -> np.ndarray:
        b = np.frombuffer(text.encode(), np.uint8).astype(np.uint32)
        seen = self._seen
        if len(b):
            seen[b] = True
        if len(b) > 1:
            seen[256 + (b[:-1] << 8 | b[1:])] = True
        if len(b) > 2:
            mixed = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
            seen[256 + 65536 + (mixed >> np.uint32(32 - TRIGRAM_BITS))] = True
        words = text.split()
        same = np.fromiter(map(eq, words, words[1:]), bool, max(0, len(words) - 1))
        for i, n in enumerate(REPEATS):
            if len(same) < n - 1:
                break
            runs = np.logical_and.reduce([same[j:len(same) - n + 2 + j] for j in range(n - 1)])
            seen[HASHED + i] = runs.any()
        found = np.flatnonzero(seen).astype(np.int32)
        seen[found] = False
        return found


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, found: np.ndarray) -> float:
        margin = float(self.weights[found].sum()) / max(1.0, len(found)) ** 0.5 + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    counts = np.full((2, FEATURES), SMOOTHING)
    for found, positive in zip(rows, y > 0, strict=True):
        counts[int(positive), found] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray,
                            cost: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> np.ndarray:
    """Weights of the hinge-loss model over scaled indicators; the last one is the bias."""
    w = np.zeros(len(scale) + 1)
    alpha = np.zeros(len(rows))
    norms = [float((scale[f] ** 2).sum()) / max(1, len(f)) + 1.0 for f in rows]
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            f, root = rows[i], max(1, len(rows[i])) ** 0.5
            gradient = y[i] * (w[f] @ scale[f] / root + w[-1]) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[f] += step / root * scale[f]
                w[-1] += step
                alpha[i] = new
    return w


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Without two classes to learn from, the score is the share of label 1 (else 0.5)."""
    y = np.where(labels > 0, 1.0, -1.0)
    if len(rows) < 4 or abs(y.sum()) == len(y):
        share = float((y > 0).mean()) if len(y) else 0.5
        share = min(max(share, 0.01), 0.99)
        return Model(np.zeros(FEATURES), 0.0, 1.0, float(np.log(share / (1 - share))))
    scale = log_count_ratios(rows, y)
    balance = len(y) / 2 / np.where(y > 0, (y > 0).sum(), (y < 0).sum())
    w = dual_coordinate_descent(rows, scale, y, COST * np.sqrt(balance))
    mean = np.abs(w[:-1]).mean()
    weights = ((1 - MIX) * mean + MIX * w[:-1]) * scale
    model = Model(weights, float(w[-1]) * MIX, 1.0, 0.0)
    margins = np.array([float(weights[f].sum()) / max(1, len(f)) ** 0.5 for f in rows]) + model.bias
    model.slope, model.offset = calibrate(margins, y > 0)
    return model


def calibrate(x: np.ndarray, positive: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's method, with smoothed targets."""
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, h = p - target, np.maximum(p * (1 - p), 1e-9)
        hessian = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-3]])
        da, db = np.linalg.solve(hessian, [(g * x).sum() + 1e-3 * a, g.sum()])
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
        if abs(da) + abs(db) < 1e-7:
            break
    return float(max(a, 1e-6)), float(b)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        for batch in slices(batches, 256, "text"):
            found = [indicators(x.as_py()).tobytes() for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.string()), batch.column("label"),
                pa.array(found, pa.binary())], ["doc_id", "label", "found"])

    sample = labelled_sample(docs, labels, label, rows).mapInArrow(
        extract, "doc_id string, label int, found binary").collect()
    sample.sort(key=lambda r: (r["doc_id"], bytes(r["found"])))
    return fit([np.frombuffer(bytes(r["found"]), np.int32) for r in sample],
               np.array([r["label"] for r in sample]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out and score of every row; an empty or null text gets a score too."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    small = Model(model.weights.astype(np.float32), model.bias, model.slope, model.offset)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        for batch in slices(batches, 256, "text"):
            scores = [small.score(indicators(x.as_py())) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", (fold_remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
                       text_of().alias("text"))
    return rows.mapInArrow(run, f"doc_id {doc_type}, held_out boolean, score double")
