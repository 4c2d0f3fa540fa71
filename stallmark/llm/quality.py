"""Quality by regularised quadratic discriminant analysis of document statistics.

Each text gives transformed statistics (logs of counts, logits of shares). Each class has a mean
and a covariance shrunk towards the pooled one and towards a multiple of the identity; the inverse of
its Cholesky factor is kept. The score comes from the difference of the two log densities (Mahalanobis
distance and determinant) plus the log prior odds, calibrated by a logistic line on the sample.

Defined cases: null and empty texts have the statistics of no words; without labels of both kinds
the score is the smoothed share of good labels; repeated rows score alike; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import SPACE, fold, segments, utf8, word_hashes
from .sampling import HELD_OUT_PARTS, labelled_sample, sampled_features

SAMPLE_ROWS = 50_000
THRESHOLD = 0.3

STATISTICS = ("words", "word_length", "distinct_words", "repeated_next", "upper", "letters", "digits", "stops", "marks", "other_marks", "spaces", "line_length")

_CLASS = np.full(256, 5, np.int64)
_CLASS[SPACE] = 0
_CLASS[65:91] = 1
_CLASS[97:123] = 2
_CLASS[128:] = 2
_CLASS[48:58] = 3
for _c in b".,;:'\"()?-":
    _CLASS[_c] = 4


def _logit(x: np.ndarray) -> np.ndarray:
    return np.log((x + 0.002) / (1.002 - x))


def statistics(texts: pa.Array) -> np.ndarray:
    """The transformed statistics of each text, a row each."""
    buf_all, offs_all = utf8(texts)
    out = [np.zeros((0, len(STATISTICS)))]
    for lo, hi in segments(offs_all):
        offs = offs_all[lo : hi + 1] - offs_all[lo]
        buf = buf_all[offs_all[lo] : offs_all[hi]]
        n, rows = np.diff(offs).astype(float), hi - lo
        owner = np.repeat(np.arange(rows), np.diff(offs))
        kinds = np.bincount(owner * 6 + _CLASS[buf], minlength=rows * 6).reshape(rows, 6).astype(float)
        exclaim = np.bincount(owner, buf == 33, rows)
        lines = 1 + np.bincount(owner, buf == 10, rows)
        h, at = word_hashes(buf, offs)
        words = np.diff(at).astype(float)
        w_owner = np.repeat(np.arange(rows), np.diff(at))
        order = np.lexsort((h, w_owner))
        a, b = h[order], w_owner[order]
        first = np.ones(len(a), bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        distinct = np.bincount(b, first, rows)
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (w_owner[1:] == w_owner[:-1])
        repeated = np.bincount(w_owner, again, rows)
        some, inner = np.maximum(words, 1), np.maximum(n - kinds[:, 0], 1)
        # Distinct words fall with length: compare with words**0.85.
        out.append(np.stack([
            np.log1p(words), np.log1p(inner / some), np.log((distinct + 1) / (words**0.85 + 1)), _logit(repeated / some), _logit(kinds[:, 1] / inner), _logit(kinds[:, 2] / inner),
            _logit(kinds[:, 3] / inner), _logit(kinds[:, 4] / inner), _logit(exclaim / inner), _logit(kinds[:, 5] / inner), _logit(kinds[:, 0] / np.maximum(n, 1)), np.log1p(words / lines),
        ], 1))
    return np.concatenate(out)


@dataclass
class Discriminant:
    """For each class: mean, inverse of its covariance's Cholesky factor, log determinant, log prior; then the calibration."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density and prior of class 1 less those of class 0."""
        d = [-0.5 * ((self.factors[c] @ (x - self.means[c]).T) ** 2).sum(0) - 0.5 * self.log_dets[c] + self.log_priors[c] for c in (0, 1)]
        return d[1] - d[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.clip(self.difference(x), -500, 500) + self.shift, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, shrink_pooled: float = 0.1, shrink_ridge: float = 0.02) -> Discriminant | float:
    """The discriminant, or the smoothed share of ones if a class is missing."""
    y = np.asarray(y).astype(int)
    if not len(y) or y.min() == y.max():
        return float((y.sum() + 1) / (len(y) + 2))
    d = x.shape[1]
    means = np.stack([x[y == c].mean(0) for c in (0, 1)])
    own = [np.cov(x[y == c].T, bias=True) if (y == c).sum() > 1 else np.zeros((d, d)) for c in (0, 1)]
    counts = np.array([(y == c).sum() for c in (0, 1)])
    pooled = (own[0] * counts[0] + own[1] * counts[1]) / counts.sum()
    factors, dets = [], []
    for c in (0, 1):
        a = max(shrink_pooled, min(1.0, d / counts[c]))  # few rows lean on the pooled covariance
        s = (1 - a) * own[c] + a * pooled
        s = (1 - shrink_ridge) * s + shrink_ridge * (np.trace(s) / d + 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(factor))
        dets.append(2 * np.log(np.diag(factor)).sum())
    m = Discriminant(means, np.stack(factors), np.array(dets), np.log(counts / counts.sum()))
    z = np.clip(m.difference(x), -500, 500)
    slope, shift = 0.2, 0.0
    for _ in range(50):  # Newton steps for the logistic line, with a little ridge
        p = 1 / (1 + np.exp(-np.clip(slope * z + shift, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((p - y) * z).sum() + 0.1 * (slope - 0.2), (p - y).sum()])
        hess = np.array([[(w * z * z).sum() + 0.1, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
        slope, shift = slope - step[0], shift - step[1]
    m.slope, m.shift = float(max(slope, 1e-3)), float(shift)
    return m


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Discriminant | float:
    """Fits on the labelled rows that are not held out, at most sample_rows of them."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = statistics(b.column(0))
            yield pa.RecordBatch.from_arrays([*(pa.array(x[:, k]) for k in range(x.shape[1])), b.column(1).cast(pa.int32())], names=[*STATISTICS, "label"])

    schema = ", ".join(f"{s} double" for s in STATISTICS) + ", label int"
    got = sampled_features(docs, labelled_sample(labels, "quality", sample_rows), extract, schema).toArrow()
    x = np.stack([got.column(s).to_numpy() for s in STATISTICS], 1) if got.num_rows else np.zeros((0, len(STATISTICS)))
    return fit(x, got.column("label").to_numpy())


def score(docs: DataFrame, model: Discriminant | float, keep_text: bool = False, text: str = "text", to: str = "score") -> DataFrame:
    """Adds the probability of good quality as column `to`; drops the text unless it is to be kept."""
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.full(b.num_rows, model) if isinstance(model, float) else model.probability(statistics(b.column(at)))
            kept = [k for k in range(len(names)) if keep_text or k != at]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), pa.array(s, pa.float64())], names=[*(f"c{k}" for k in kept), "score"])

    # Columns go by their place, as mapInArrow does not take every name.
    kept = [(f"c{k}", f) for k, f in enumerate(docs.schema) if keep_text or f.name != text]
    schema = StructType([*(StructField(c, f.dataType) for c, f in kept), StructField("score", DoubleType())])
    return docs.toDF(*(f"c{k}" for k in range(len(names)))).mapInArrow(run, schema).toDF(*(f.name for _, f in kept), to)


def quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = train(docs, labels, sample_rows)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", HELD_OUT_PARTS) == 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    return score(own, model).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
