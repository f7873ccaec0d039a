"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

Document statistics (ratios and lengths, no words) are standardised and mapped to random
cosine features, whose inner products approximate a Gaussian kernel.  Every partition sums
its share of the normal equations; the sums are added up in two steps on the executors,
and the driver solves one system of ``FEATURES`` unknowns.  A part of the labelled rows is
set aside for calibration: counts per score bin, made monotone by pooling neighbours.

The driver sees the summed matrices and ``BINS`` counts, whatever the number of rows.

Cases.  Null and empty texts have the statistics of the empty text and get a score like
all others.  Without labelled rows, or with labels of one kind only, every score is the
share of label 1 (0.5 without labels).  Repeated rows and labels count as they come; a
label without a document teaches nothing.  Empty table: empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from duskwatch.llm.common import by_slices, id_key, stored

FEATURES, GAMMA, RIDGE, SEED = 256, 0.08, 1e-3, 23
BINS = 512

STATS = ("log_words", "word_length", "upper", "digit", "space", "symbol", "bar", "punct",
         "bang", "long_bytes", "line_length", "repeat_lines", "distinct_words", "distinct_grams",
         "longest_word", "short_words", "entropy", "symbol_words")
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t\n\r",
            "symbol": b"#$%&*<>@^_~{}[]\\=+", "bar": b"|", "punct": b".,;:?'\"()-", "bang": b"!"}
_PICK = np.zeros((256, len(_CLASSES)))
for _i, _chars in enumerate(_CLASSES.values()):
    _PICK[list(_chars), _i] = 1
_SYMBOLS = frozenset("#$%&*|<>!")


def statistics(text: str | None) -> list[float]:
    """The numbers in STATS for a whole text."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    hist = np.bincount(raw, minlength=256)
    n, words, lines = max(len(raw), 1), text.split(), text.split("\n")
    share = hist @ _PICK / n
    p = hist[hist > 0] / n
    w, lower = max(len(words), 1), text.lower().split()
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    full = [x for x in lines if x.strip()]
    return [np.log1p(len(words)), lengths.mean(), *share, hist[128:].sum() / n,
            np.log1p(len(text) / max(len(lines), 1)), 1 - len(set(full)) / max(len(full), 1),
            len(set(lower)) / w, len(set(zip(lower, lower[1:], lower[2:]))) / max(w - 2, 1),
            np.log1p(lengths.max()), (lengths <= 3).mean(), -(p * np.log(p)).sum() if len(p) else 0.0,
            sum(not _SYMBOLS.isdisjoint(x) for x in words) / w]


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and stats of every row."""
    def work(rows: dict) -> dict:
        return {"doc_id": rows["doc_id"],
                "stats": [[float(x) for x in statistics(t)] for t in rows["text"]]}
    return by_slices(docs.select("doc_id", "text"), work, "doc_id long, stats array<double>")


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    knots: np.ndarray      # raw scores
    values: np.ndarray     # calibrated scores, rising

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier((stats - self.mean) / self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.values[0])
        return np.interp(self.raw(stats), self.knots, self.values)


def fourier(x: np.ndarray) -> np.ndarray:
    """Random cosine features of standardised statistics, and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0, np.sqrt(2 * GAMMA), (x.shape[1], FEATURES))
    b = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.sqrt(2 / FEATURES) * np.cos(np.clip(x, -6, 6) @ w + b)
    return np.hstack([z, np.ones((len(x), 1))])


def _matrix(column) -> np.ndarray:
    return np.vstack(column.to_numpy()) if len(column) else np.zeros((0, len(STATS)))


def _summed(df: DataFrame, part) -> np.ndarray:
    """Sum a vector over partitions: one per partition, then per group, then the groups."""
    def per_partition(frames):
        total = None
        for pdf in frames:
            if len(pdf):
                v = part(pdf)
                total = v if total is None else total + v
        if total is not None:
            yield pd.DataFrame({"v": [total]})

    def per_group(frames):
        total = None
        for pdf in frames:
            for v in pdf["v"]:
                total = v.copy() if total is None else total + v
        if total is not None:
            yield pd.DataFrame({"v": [total]})

    sums = df.mapInPandas(per_partition, "v array<double>")
    rows = sums.repartition(8).mapInPandas(per_group, "v array<double>").collect()
    return np.sum([np.array(r[0]) for r in rows], axis=0) if rows else np.zeros(0)


def pool(hits: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rising fit to hits / counts: neighbours that fall are pooled."""
    blocks: list[list[float]] = []
    for h, c in zip(hits, counts):
        blocks.append([h, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            h2, c2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + h2, blocks[-1][1] + c2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), h / c) for h, c, k in blocks])


def fit(rows: DataFrame) -> QualityModel:
    """Learn from rows (doc_id, stats, label); one in four is kept for calibration."""
    rows = rows.where("label is not null")
    aside = F.pmod(F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(4)) == 0
    train = rows.where(~aside)
    d = len(STATS)

    def moments(pdf):
        x = _matrix(pdf["stats"])
        return np.concatenate([[len(x), pdf["label"].sum()], x.sum(0), (x * x).sum(0)])

    m = _summed(train, moments)
    if not len(m) or m[1] in (0, m[0]):
        base = float(m[1] / m[0]) if len(m) else 0.5
        return QualityModel(np.zeros(d), np.ones(d), None, np.zeros(1), np.array([base]))
    mean = m[2:2 + d] / m[0]
    scale = np.sqrt(np.maximum(m[2 + d:] / m[0] - mean**2, 1e-12))

    def normal(pdf):
        z = fourier((_matrix(pdf["stats"]) - mean) / scale)
        return np.concatenate([(z.T @ z).ravel(), z.T @ pdf["label"].to_numpy(float)])

    s = _summed(train, normal)
    k = FEATURES + 1
    weights = np.linalg.solve(s[:k * k].reshape(k, k) + RIDGE * m[0] * np.eye(k) / k, s[k * k:])
    first = QualityModel(mean, scale, weights, np.zeros(1), np.zeros(1))

    def bins(pdf):
        at = np.clip(((first.raw(_matrix(pdf["stats"])) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        y = pdf["label"].to_numpy(float)
        return np.concatenate([np.bincount(at, y, BINS), np.bincount(at, minlength=BINS)])

    b = _summed(rows.where(aside), bins)
    if not len(b):
        return QualityModel(mean, scale, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    used = b[BINS:] > 0
    centre = ((np.arange(BINS) + 0.5) / BINS * 2 - 0.5)[used]
    return QualityModel(mean, scale, weights, centre, pool(b[:BINS][used], b[BINS:][used]))


def predict(stats: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, score and predicted of every row."""
    shared = stats.sparkSession.sparkContext.broadcast(model)   # fixed size

    def work(frames):
        for pdf in frames:
            score = shared.value.score(_matrix(pdf["stats"]))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": score,
                                "predicted": (score >= threshold).astype("int32")})

    return stats.mapInPandas(work, "doc_id long, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, teach, threshold: float = 0.3) -> DataFrame:
    """Score all documents; ``teach`` (a condition on doc_id) names the rows to learn from.

    Statistics are computed once, stored, and used for both.
    """
    stats = stored(with_statistics(docs), "stats")
    marks = labels.where(teach).select(id_key().alias("id"), F.col("quality").alias("label"))
    rows = (stats.where(teach).withColumn("id", id_key()).join(marks, "id")
            .select("doc_id", "stats", "label"))
    return predict(stats, fit(rows), threshold)
