"""Bounded samples of labelled documents, as hashed features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import subwords, tables


@dataclass
class Sample:
    """Training rows: buckets and counts of each text, its label and its fold in the training set."""

    buckets: list[np.ndarray]
    counts: list[np.ndarray]
    labels: np.ndarray
    ids: np.ndarray

    def __len__(self) -> int:
        return len(self.labels)


def _place(key: str | Column) -> Column:
    """Where a key stands between 0 and 1, by its hash."""
    return F.xxhash64(F.lit(17), F.col(key) if isinstance(key, str) else key).cast("double") / 2.0**64 + 0.5


def thinned(rows: DataFrame, key: str, most: int, by: str | None = None) -> DataFrame:
    """About ``most`` rows, those with the smallest hash of the key; rows of one key stay together.

    With ``by``, each of its values gets an equal share, so rare classes are all taken. The
    shares are cut by a hash threshold computed from counts, without a sort or a window.
    """
    classes = rows.groupBy(by).count().collect() if by else [(None, rows.count())]
    share = max(1, most // max(1, len(classes)))
    place = _place(key)
    cut = F.lit(0.0)
    for value, count in classes:
        part = F.lit(min(1.0, share / max(1, count)))
        cut = F.when(F.col(by) == value, part).otherwise(cut) if by else part
    return rows.where(place < cut)


def bounded(rows: DataFrame, key: str, most: int, by: str | None = None) -> DataFrame:
    """At most ``most`` of the :func:`thinned` rows, by the hash of the key."""
    return thinned(rows, key, most, by).orderBy(_place(key), F.col(key)).limit(most)


def gather(
    documents: DataFrame, chosen: DataFrame, key: str, label: str, most: int,
    buckets: int, widths: tuple[int, ...], lower: bool, pairs: bool = False,
) -> Sample:
    """Features of the chosen rows' whole texts. ``chosen`` is a bounded sample (key, label).

    An id that several documents or labels have comes with each pair of them, all in all at
    most ``most`` rows.
    """
    texts = documents.select(F.col(key).cast("long").alias("k"), F.col("text").alias("t"))
    labelled = F.broadcast(chosen.select(F.col(key).cast("long").alias("k"), F.col(label).cast("long").alias("y")))
    return gathered(texts.join(labelled, "k").select("k", "t", "y"), most, buckets, widths, lower, pairs)


def gathered(rows: DataFrame, most: int, buckets: int, widths: tuple[int, ...], lower: bool, pairs: bool = False) -> Sample:
    """Features of at most ``most`` rows (k, t, y: id, text, label).

    More rows, as ids with many copies make them, are thinned by a hash of id and text before
    they are gathered; of equal rows any will do.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in tables.slices(batches):
            out = []
            for k, text, y in zip(*(c.to_pylist() for c in columns), strict=True):
                b, n = subwords.counted(text or "", buckets, widths, lower, pairs)
                out.append((k, y, b.astype("<i4").tobytes(), n.astype("<i4").tobytes()))
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["k", "y", "b", "n"]
            )

    rows = rows.select(F.col("k").cast("long"), "t", F.col("y").cast("long"))
    count = rows.count()  # reads no text
    if count > most:
        rows = rows.where(_place(F.xxhash64("k", "t", "y")) < 1.5 * most / count)
    made = rows.mapInArrow(hashed, "k long, y long, b binary, n binary")
    got = (made.limit(2 * most) if count > most else made).toArrow()
    if len(got) > most:
        got = got.take(pa.array(np.random.default_rng(17).permutation(len(got))[:most]))
    got = got.sort_by([("k", "ascending"), ("y", "ascending")])
    blob = lambda name: [np.frombuffer(x, dtype="<i4") for x in got[name].to_pylist()]
    return Sample(
        blob("b"), blob("n"), np.array(got["y"].to_pylist(), dtype=np.int64), np.array(got["k"].to_pylist(), dtype=np.int64)
    )
