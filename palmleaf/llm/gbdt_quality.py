"""Quality classifier: histogram gradient-boosted trees over document statistics, flattened into arrays.

Training takes at most SAMPLE labelled rows, those whose hashed ids are lowest; features are made on the executors and only
that bounded matrix comes to the driver. Scoring walks all trees for a batch of documents at once in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, slices

#: The bound on labelled rows that the classifier is fitted on.
SAMPLE = 20_000
TREES, DEPTH, RATE, BINS, LEAST_ROWS, L2 = 60, 4, 0.15, 64, 8, 1.0

UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = b"abcdefghijklmnopqrstuvwxyz"
DIGITS = b"0123456789"
SETS = (UPPER, LOWER, DIGITS, b" ", b"\n", b".", b",", b"!?", b"#*$%&", b"|<>{}[]\\/_=+~^", b"'\"`;:()-@")
FEATURES = ("log_bytes", "log_words", "word_len", "longest_word", "non_ascii", *(f"share_{i}" for i in range(len(SETS))), "distinct_words", "top_word", "distinct_pairs", "repeated_lines", "words_per_line", "log_lines", "end_marks", "ratio", "ratio_short", "symbol_words")


def features(raw: bytes) -> list[float]:
    """The statistics of one whole text; all shares are 0 for an empty one."""
    words, n = raw.split(), len(raw)
    if not words:
        return [float(np.log1p(n))] + [0.0] * (len(FEATURES) - 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    shares = [(n - len(raw.translate(None, s))) / n for s in SETS]
    press = zstandard.ZstdCompressor(level=1)
    symbols = sum(w[-1:] in b"#*$%&|!" for w in words)
    return [
        float(np.log1p(n)), float(np.log1p(len(words))), n / len(words) - 1, float(min(max(map(len, counts)), 1000)), 1 - len(raw.decode("utf-8", "replace")) / n, *shares,
        len(counts) / len(words), max(counts.values()) / len(words), pairs / max(len(words) - 1, 1), 1 - len(set(lines)) / len(lines), len(words) / len(lines), float(np.log1p(len(lines))),
        sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines), len(press.compress(raw)) / n, float(np.mean([len(press.compress(raw[a : a + 1024])) / len(raw[a : a + 1024]) for a in range(0, n, 1024)])), symbols / len(words),
    ]


@dataclass
class Trees:
    """A forest in arrays: node i of tree t is at t * nodes + i, its children at 2i + 1 and 2i + 2."""

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    start: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        binned = np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]) if len(x) else np.zeros((0, len(self.edges)), np.int64)
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (binned[rows, self.feature[t, at]] > self.cut[t, at])
            out += self.value[t, at]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Newton boosting on the logistic loss, split by histograms. Without rows or without both labels it predicts the share of 1."""
    nodes, wide = 2 ** (DEPTH + 1) - 1, max(x.shape[1] if x.ndim == 2 else 0, 1)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    start = float(np.log(share / (1 - share)))
    feature, cut, value = np.zeros((TREES, nodes), np.int64), np.full((TREES, nodes), BINS, np.int64), np.zeros((TREES, nodes))
    if not len(y) or y.min() == y.max():
        return Trees([np.zeros(0)] * wide, feature[:0], cut[:0], value[:0], start)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for j in range(wide)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)])
    flat, margin = binned + np.arange(wide) * BINS, np.full(len(y), start)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        place = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            for node in range(2**depth - 1, 2 ** (depth + 1) - 1):
                rows = np.flatnonzero(place == node)
                if len(rows) < 2 * LEAST_ROWS:
                    continue
                at, size = flat[rows].ravel(), wide * BINS
                repeat = lambda v: np.bincount(at, np.repeat(v[rows], wide), size).reshape(wide, BINS).cumsum(1)  # noqa: B023, E731
                g, h, n = repeat(grad), repeat(hess), np.bincount(at, minlength=size).reshape(wide, BINS).cumsum(1)
                gain = g**2 / (h + L2) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + L2) - g[:, -1:] ** 2 / (h[:, -1:] + L2)
                gain[(n < LEAST_ROWS) | (n[:, -1:] - n < LEAST_ROWS)] = -1
                j, b = np.unravel_index(int(gain.argmax()), gain.shape)
                if gain[j, b] > 1e-6:
                    feature[t, node], cut[t, node] = j, b
            place = 2 * place + 1 + (binned[np.arange(len(y)), feature[t, place]] > cut[t, place])
        g, h = np.bincount(place, grad, nodes), np.bincount(place, hess, nodes)
        value[t] = -RATE * g / (h + L2)
        margin += value[t, place]
    return Trees(edges, feature, cut, value, start)


def training_matrix(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most sample rows whose id is outside the held-out third."""
    keys = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (id_remainder("doc_id", 3) != 1)).select(F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("label"))
    # the sampled keys are bounded by sample, so they may be broadcast
    chosen = keys.orderBy(F.xxhash64("label_id"), "label_id", "label").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            yield pa.record_batch([part.column(0).cast(pa.int64()), part.column(2), pa.array([features(x or b"") for x in texts], pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    made = rows.mapInArrow(run, "doc_id long, label double, x array<double>").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample).toArrow()
    x = np.asarray(made.column("x").combine_chunks().flatten()).reshape(-1, len(FEATURES))
    return x, made.column("label").to_numpy()


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (doc_id, text); labels has doc_id, quality.

    Null or empty texts get the score of an empty text. A null id is never trained on and counts as an empty text for the
    fold. Rows with a null label are left out of training; without labels of both kinds all scores are equal.
    """
    model = fit(*training_matrix(docs, labels, sample))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            score = model.scores(np.array([features(x or b"") for x in texts]))
            yield pa.record_batch([rows.column(0).cast(pa.int64()), rows.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], schema=schema)

    return docs.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs, all columns, that the classifier predicts as good; nulls and repeated rows are as in classify()."""
    model = fit(*training_matrix(docs, labels, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            yield rows.filter(pa.array(model.scores(np.array([features(x or b"") for x in texts])) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
