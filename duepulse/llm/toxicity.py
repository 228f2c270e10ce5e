"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

P(grade <= k) = sigmoid(threshold_k - w.x) with one weight vector w for all thresholds, which
are kept in order. x holds log(1 + count) of hashed words and character n-grams. An L1 penalty
leaves few weights, so a long harmless text doesn't add up to a grade.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import samples, subwords, tables
from .samples import Sample


#: Names that the operator adds to a table's own; its own can be severity and so on.
ADDED = ("toxicity_severity", "toxicity_grade", "toxicity_rejected")


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    widths: tuple[int, ...] = (5, 6)
    #: Grades above 0 that toxic rows are parted into.
    levels: int = 3
    #: A feature needs to be in so many training rows, and so much oftener in those graded above 0.
    least_rows: int = 5
    least_ratio: float = 2.0
    penalty: float = 5e-5
    steps: int = 500
    rate: float = 0.3


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, raw: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, …: one column each."""
        return _sigmoid(raw[:, None] - self.thresholds[None, :])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def grades(sample: Sample, settings: Settings) -> np.ndarray:
    """Severity grades of rows labelled 0 or 1.

    Grade 0 is label 0. A row of label 1 is graded by how much of it is telling: the occurrences
    of features found five times as often in rows of label 1, per root of the text's length, parted
    at equal shares of the rows of label 1.
    """
    toxic = sample.labels == 1
    seen = [np.zeros(settings.buckets) for _ in range(2)]
    for b, y in zip(sample.buckets, sample.labels, strict=True):
        seen[int(y)][b] += 1
    share = [(s + 0.5) / (max(1, n) + 1.0) for s, n in zip(seen, ((~toxic).sum(), toxic.sum()), strict=True)]
    telling = (share[1] > 5 * share[0]) & (seen[1] >= 3)
    dose = np.array([(n * telling[b]).sum() / max(1.0, n.sum()) ** 0.5 for b, n in zip(sample.buckets, sample.counts, strict=True)])
    cuts = np.quantile(dose[toxic], np.arange(1, settings.levels) / settings.levels) if toxic.any() else []
    return np.where(toxic, 1 + np.searchsorted(cuts, dose, side="left"), 0)


def fit(sample: Sample, grade: np.ndarray, row_weights: np.ndarray, settings: Settings) -> Model:
    """Proximal AdaGrad on the weighted likelihood; thresholds are the first one and log gaps."""
    s, levels = settings, int(grade.max(initial=1))
    sizes = np.array([len(b) for b in sample.buckets])
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    column = np.concatenate(sample.buckets) if len(row) else np.zeros(0, np.int64)
    value = np.log1p(np.concatenate(sample.counts), dtype=np.float32) if len(row) else np.zeros(0)
    seen = np.bincount(column, minlength=s.buckets)
    in_graded = np.bincount(column, weights=(grade > 0)[row], minlength=s.buckets)
    graded = max(1, int((grade > 0).sum()))
    rate = (in_graded + 0.5) / (graded + 1), (seen - in_graded + 0.5) / (max(1, len(grade) - graded) + 1)
    used = ((seen >= s.least_rows) & (rate[0] > s.least_ratio * rate[1]))[column]
    row, column, value = row[used], column[used], value[used]
    share = row_weights / row_weights.sum()
    w, gaps = np.zeros(s.buckets), np.zeros(levels)
    first = np.average(grade == 0, weights=row_weights)
    gaps[0] = np.log(max(first, 1e-3) / max(1 - first, 1e-3))
    past_w, past_g = np.full(s.buckets, 1e-8), np.full(levels, 1e-8)
    for _ in range(s.steps):
        theta = np.cumsum(np.concatenate((gaps[:1], np.exp(gaps[1:]))))
        edges = np.concatenate(([-np.inf], theta, [np.inf]))
        raw = np.bincount(row, weights=value * w[column], minlength=len(sizes))
        low, high = (_sigmoid(np.clip(edges[grade + i] - raw, -40, 40)) for i in (0, 1))
        inside = np.maximum(high - low, 1e-9)
        grad = np.bincount(column, weights=value * (share * (1 - high - low))[row], minlength=s.buckets)
        d_theta = np.zeros(levels)
        for k in range(levels):
            d_theta[k] = (share * (low * (1 - low) * (grade == k + 1) - high * (1 - high) * (grade == k)) / inside).sum()
        behind = np.cumsum(d_theta[::-1])[::-1]  # a gap moves all thresholds behind it
        g = behind * np.concatenate(([1.0], np.exp(gaps[1:])))
        past_w += grad**2
        past_g += g**2
        step = s.rate / np.sqrt(past_w)
        w -= step * grad
        w = np.sign(w) * np.maximum(np.abs(w) - step * s.penalty, 0)
        gaps -= s.rate / np.sqrt(past_g) * g
    return Model(w, np.cumsum(np.concatenate((gaps[:1], np.exp(gaps[1:])))))


def score_toxicity(
    documents: DataFrame, labels: DataFrame, *, limit: float = 0.25,
    most_labelled: int = 4096, settings: Settings = Settings(),
) -> DataFrame:
    """doc_id, held_out, severity (expected grade), grade (likeliest) and rejected of every document.

    Learns ``labels.toxic`` (0 or 1, graded by :func:`grades`) from at most ``most_labelled``
    labelled documents, as many of either label, whose fold is not the held-out one; rows are
    weighted back to the labels' true shares. Severity is the sum over k of P(grade >= k);
    ``rejected`` is P(grade >= 1) >= limit. Only the text enters a score, and all of it.

    Null or empty text: a text without features. Null doc_id: scored, never learned from. Labels
    that are null or not 0 or 1 are left out. Without labelled rows of both kinds nothing is
    rejected and severity is 0. Equal texts get equal scores. Extra columns are ignored.
    """
    kept = documents.select("doc_id", "text")
    return with_severity(kept, documents, labels, limit, most_labelled, settings).select(
        "doc_id", tables.held_out(F.col("doc_id")).alias("held_out"),
        *[F.col(a).alias(n) for a, n in zip(ADDED, ("severity", "grade", "rejected"), strict=True)],
    )


def with_severity(
    rows: DataFrame, documents: DataFrame, labels: DataFrame, limit: float = 0.25,
    most_labelled: int = 4096, settings: Settings = Settings(),
) -> DataFrame:
    """The rows, which have a text, with the columns ADDED."""
    usable = labels.select("doc_id", "toxic").where("toxic in (0, 1) and doc_id is not null").where(~tables.held_out(F.col("doc_id")))
    shares = dict(usable.groupBy("toxic").count().collect())
    s = settings
    chosen = samples.bounded(usable, "doc_id", most_labelled, by="toxic")
    sample = samples.gather(documents, chosen, "doc_id", "toxic", most_labelled, s.buckets, s.widths, True)
    if len(sample) and len(np.unique(sample.labels)) == 2:
        had = np.bincount(sample.labels, minlength=2)
        model = fit(sample, grades(sample, s), np.array([shares[y] / had[y] for y in sample.labels]), s)
    else:
        model = Model(np.zeros(s.buckets), np.full(s.levels, 40.0))
    used = np.flatnonzero(model.weights)
    sent = rows.sparkSession.sparkContext.broadcast((used, model.weights[used], model.thresholds))
    at = rows.columns.index("text")
    names = [*rows.columns, *ADDED]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weights, thresholds = sent.value
        dense = np.zeros(s.buckets)
        dense[held] = weights
        known = Model(dense, thresholds)
        for columns in tables.slices(batches):
            raw = _raw([t or "" for t in columns[at].to_pylist()], dense, s)
            above = known.at_least(raw)
            severity = above.sum(axis=1)
            chance = -np.diff(np.column_stack((np.ones(len(raw)), above, np.zeros(len(raw)))), axis=1)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(severity), pa.array(chance.argmax(axis=1).astype(np.int32)), pa.array(above[:, 0] >= limit)],
                names=names,
            )

    added = (T.DoubleType(), T.IntegerType(), T.BooleanType())
    new = [T.StructField(n, t) for n, t in zip(names[-3:], added, strict=True)]
    return rows.mapInArrow(scored, T.StructType([*rows.schema.fields, *new]))


def _raw(texts: list[str], weights: np.ndarray, s: Settings) -> np.ndarray:
    """w.x of each text; only buckets with a weight are counted."""
    owners, buckets = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for owner, b in subwords.features(texts, s.buckets, s.widths, True):
        hit = np.flatnonzero(weights[b])
        owners.append(owner[hit])
        buckets.append(b[hit])
    pairs, n = np.unique(np.concatenate(owners) * s.buckets + np.concatenate(buckets), return_counts=True)
    return np.bincount(pairs // s.buckets, weights=np.log1p(n) * weights[pairs % s.buckets], minlength=len(texts))
