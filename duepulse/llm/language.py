"""Language of documents by averaged subword embeddings, with calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import embeddings_model as em
from . import samples, subwords, tables

SETTINGS = em.Settings(widths=(2, 3), lower=True, dim=16, epochs=4)
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")


def identify_language(
    documents: DataFrame, *, most_labelled: int = 3072, accepted_error: float = 0.01,
    settings: em.Settings = SETTINGS,
) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected for every document.

    Learns ``lang`` from at most ``most_labelled`` documents with a language and an id whose
    fold is not the held-out one, an equal share for each language. Score is the probability of
    the predicted language after temperature scaling on calibration rows. ``rejected`` marks
    documents whose score is below the lowest one at which the calibration rows accepted have
    at most ``accepted_error`` wrong; a user who wants no doubtful languages drops those.

    Null text or no letter: ``und``, score 0, rejected. Nothing to learn from: the same for all.
    Null doc_id: predicted, never learned from. Rows of one id are chosen together, each with its
    own language. A letter is what Unicode calls one. Extra columns are ignored.
    """
    known = documents.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).where(~tables.held_out(F.col("doc_id")))
    chosen = samples.thinned(known.select("doc_id", "lang", "text"), "doc_id", most_labelled, by="lang")
    names = sorted(r[0] for r in chosen.select("lang").distinct().orderBy("lang").limit(most_labelled).collect())
    code = F.lit(None).cast("long")
    for i, name in enumerate(names):
        code = F.when(F.col("lang") == name, i).otherwise(code)
    # The text comes with its row's language: rows that share an id stay apart.
    rows = chosen.select(F.col("doc_id").alias("k"), F.col("text").alias("t"), code.alias("y")).where("y is not null")
    sample = samples.gathered(rows, most_labelled, settings.buckets, settings.widths, settings.lower, settings.pairs)
    if not len(sample):
        table, least, model = np.zeros((settings.buckets, 1), np.float32), 2.0, None
    else:
        model, seen, truth = em.train(sample, settings)
        names = [names[c] for c in model.classes]
        table = model.table.astype(np.float32)
        least = _least_score(seen, truth, accepted_error)
    sent = documents.sparkSession.sparkContext.broadcast((table, model and (model.bias, model.temperature)))
    s = settings

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, rest = sent.value
        for ids, held, part in tables.slices(batches):
            texts = [t or "" for t in part.to_pylist()]
            letters = np.array([bool(rest and _LETTER.search(t)) for t in texts], dtype=bool)
            if rest:
                p = em.softmax((subwords.mean_weights(texts, weights, s.widths, s.lower, s.pairs, s.prior) + rest[0]) / rest[1])
                best = p.argmax(axis=1)
                score = np.where(letters, p[np.arange(len(texts)), best], 0.0)
                lang = [names[k] if ok else UNDETERMINED for k, ok in zip(best, letters, strict=True)]
            else:
                score, lang = np.zeros(len(texts)), [UNDETERMINED] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [ids, held, pa.array(lang, pa.string()), pa.array(score), pa.array(score < least)],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return documents.select("doc_id", tables.held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        predicted, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    )


def _least_score(seen: np.ndarray, truth: np.ndarray, accepted_error: float) -> float:
    """The lowest score from which on no more than the accepted share is wrong."""
    if not len(truth):
        return 0.0
    score, wrong = seen.max(axis=1), seen.argmax(axis=1) != truth
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(wrong[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share <= accepted_error)
    return float(score[order[good[-1]]]) if len(good) else 1.0
