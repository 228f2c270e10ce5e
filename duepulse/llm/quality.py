"""Quality of documents by supervised subword embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import embeddings_model as em
from . import samples, subwords, tables

SETTINGS = em.Settings(pairs=True)


def score_quality(
    documents: DataFrame, labels: DataFrame, *, threshold: float = 0.7,
    most_labelled: int = 4096, settings: em.Settings = SETTINGS,
) -> DataFrame:
    """doc_id, held_out, score (probability of label 1) and predicted for every document.

    Learns ``labels.quality`` (0 or 1) from at most ``most_labelled`` labelled documents whose
    fold is not the held-out one. Each word and character n-gram of a text has a learned hashed
    vector; the mean of a text's vectors goes to a softmax. Only the text enters a score.

    Null or empty text: the score of a text without features, which is the calibrated bias.
    Null doc_id: scored, never learned from. Labels that are null or not 0 or 1 are left out;
    several labels of one document each count. With labels of one class only, every score is
    that class; with none, 0.5. Equal texts get equal scores. Extra columns are ignored.
    """
    rows = labels.select("doc_id", "quality").where("quality in (0, 1)").where(~tables.held_out(F.col("doc_id"))).where("doc_id is not null")
    chosen = samples.bounded(rows, "doc_id", most_labelled)
    sample = samples.gather(documents, chosen, "doc_id", "quality", most_labelled, settings.buckets, settings.widths, settings.lower, settings.pairs)
    if len(sample) and len(np.unique(sample.labels)) == 2:
        model, _, _ = em.train(sample, settings)
        table = (model.table[:, 1] - model.table[:, 0])[:, None].astype(np.float32) / model.temperature
        bias = float(model.bias[1] - model.bias[0]) / model.temperature
    else:
        table = np.zeros((settings.buckets, 1), dtype=np.float32)
        bias = 0.0 if not len(sample) else 40.0 * (2 * int(sample.labels[0]) - 1)
    sent = documents.sparkSession.sparkContext.broadcast(table)
    s = settings

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held, part in tables.slices(batches):
            texts = [t or "" for t in part.to_pylist()]
            means = subwords.mean_weights(texts, sent.value, s.widths, s.lower, s.pairs, s.prior)[:, 0]
            score = 1 / (1 + np.exp(-np.clip(means + bias, -60, 60)))
            yield pa.RecordBatch.from_arrays(
                [ids, held, pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return documents.select("doc_id", tables.held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        scored, "doc_id long, held_out boolean, score double, predicted int"
    )
