"""Compression of vectors to short codes: integer codebooks for parts, searched by a tree.

Each vector becomes whole numbers and is cut into equal parts; a part's code is the index of its
nearest codebook entry. Codebooks are learned in rounds: tasks find the nearest entries through a
:class:`~duepulse.llm.gnat.Gnat` and sum the parts of each entry, Spark adds the sums up, and
the driver, which holds the codebooks alone, divides. Everything is exact, so results don't
depend on how rows are dealt out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tables
from .gnat import Gnat

#: Entries of a codebook: an index is two hexadecimal digits.
ENTRIES = 256
#: Whole numbers are below this, so that squared distances over up to 4096 components of a part stay exact.
MOST = 1 << 24
#: Labels that are broadcast with their sums; with more, the join shuffles.
MOST_BROADCAST = 500_000


@dataclass
class Codebooks:
    """parts × entries × width whole numbers, for vectors of ``dimension`` components."""

    entries: np.ndarray
    dimension: int

    def text(self) -> str:
        """All components by part, entry and position, as decimals with commas between."""
        return ",".join(map(str, self.entries.ravel().tolist()))

    def digest(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def whole_vectors(embeddings: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id, label and whole: floor(scale * x) of each component.

    Rows whose vector is null or holds a null or non-finite component are left out. A component
    of MOST or more after scaling is an error, since the arithmetic behind would not be exact.
    """

    def number(x: Column) -> Column:
        scaled = x * scale
        far = F.raise_error(F.lit("a component is too large for whole numbers")).cast("bigint")
        return F.when(F.abs(scaled) < MOST, F.floor(scaled)).otherwise(far)

    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("v").isNotNull() & finite).select("vec_id", "label", F.transform("v", number).alias("whole"))


def _matrix(column: pa.Array, dimension: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have ``dimension`` components, and theirs as rows × parts × width, filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    fit = np.flatnonzero(sizes == dimension)
    starts = column.offsets.to_numpy()[:-1][fit]
    numbers = column.values.to_numpy(zero_copy_only=False)
    width = -(-dimension // parts)
    whole = np.zeros((len(fit), parts * width), dtype=np.int64)
    if len(fit):
        whole[:, :dimension] = numbers[starts[:, None] + np.arange(dimension)]
    return fit, whole.reshape(len(fit), parts, width)


def _first_entries(rows: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The parts of the vectors with the smallest ids; null ids are last, equal ones by their vector."""
    sized = rows.where(F.size("whole") > 0)
    order = [F.col("vec_id").asc_nulls_last(), F.col("whole")]
    first = sized.orderBy(*order).limit(1).collect()
    if not first:
        return None
    dimension = len(first[0]["whole"])
    chosen = sized.where(F.size("whole") == dimension).orderBy(*order).limit(entries).collect()
    width = -(-dimension // parts)
    start = np.zeros((len(chosen), parts * width), dtype=np.int64)
    start[:, :dimension] = [r["whole"] for r in chosen]
    return Codebooks(start.reshape(len(chosen), parts, width).transpose(1, 0, 2).copy(), dimension)


def _summed(rows: DataFrame, books: Codebooks) -> DataFrame:
    """part, entry, n and sums: the parts that are nearest to each entry, one row for each in a task."""
    parts, entries, width = books.entries.shape
    shared = rows.sparkSession.sparkContext.broadcast([Gnat(book) for book in books.entries])
    dimension = books.dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        counts = np.zeros((parts, entries), dtype=np.int64)
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        for batch in batches:
            _, whole = _matrix(batch.column(0), dimension, parts)
            for p in range(parts):
                index, _ = trees[p].nearest(whole[:, p])
                counts[p] += np.bincount(index, minlength=entries)
                np.add.at(sums[p], index, whole[:, p])
        part, entry = np.nonzero(counts)
        told = sums[part, entry]
        offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]), pa.ListArray.from_arrays(offsets, pa.array(told.ravel()))],
            names=["part", "entry", "n", "sums"],
        )

    return rows.select("whole").mapInArrow(run, "part int, entry int, n long, sums array<long>")


def learn(rows: DataFrame, *, parts: int = 4, entries: int = ENTRIES, rounds: int = 4) -> Codebooks | None:
    """Codebooks of the rows of :func:`whole_vectors`; None where no row has components.

    They start as the parts of the vectors with the smallest ids. Each round gives every part to
    its nearest entry, then moves an entry to the floor of the mean of its parts; an entry
    without parts stays. Vectors of another dimension than the first one's take no part.
    """
    books = _first_entries(rows, parts, entries)
    if books is None:
        return None
    width = books.entries.shape[2]
    for _ in range(rounds):
        exact = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
        for row in _summed(rows, books).groupBy("part", "entry").agg(F.sum("n").alias("n"), *exact).collect():  # a row for each entry
            books.entries[row["part"], row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    return books


def encode(rows: DataFrame, books: Codebooks | None) -> DataFrame:
    """vec_id, label, code and error for the rows of :func:`whole_vectors`.

    code has the index of the nearest entry of each part, as two hexadecimal digits; error is the
    squared distance to them. Both are null for a vector of another dimension than the codebooks'.
    """
    if books is None:
        return rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    parts, dimension = books.entries.shape[0], books.dimension
    shared = rows.sparkSession.sparkContext.broadcast([Gnat(book) for book in books.entries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            fit, whole = _matrix(batch.column(2), dimension, parts)
            codes = np.full(batch.num_rows, None, dtype=object)
            errors = np.zeros(batch.num_rows, dtype=np.int64)
            indexes = np.empty((len(fit), parts), dtype=np.uint8)
            for p in range(parts):
                index, square = trees[p].nearest(whole[:, p])
                indexes[:, p] = index
                errors[fit] += square
            codes[fit] = [row.tobytes().hex() for row in indexes]
            missing = np.ones(batch.num_rows, dtype=bool)
            missing[fit] = False
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, mask=missing)],
                names=["vec_id", "label", "code", "error"],
            )

    return rows.select("vec_id", "label", "whole").mapInArrow(run, "vec_id long, label string, code string, error long")


def decode(codes: DataFrame, books: Codebooks, scale: int = 1024) -> DataFrame:
    """The codes with ``approximate``: the vector that their entries stand for; null for a null code."""
    shared = codes.sparkSession.sparkContext.broadcast(books)

    @F.pandas_udf("array<double>")
    def approximate(column):  # noqa: ANN001, ANN202
        entries, dimension = shared.value.entries, shared.value.dimension
        place = np.arange(len(entries))
        return column.map(lambda code: None if code is None else (entries[place, list(bytes.fromhex(code))].ravel()[:dimension] / scale).tolist())

    return codes.withColumn("approximate", approximate(F.col("code")))


def compress(embeddings: DataFrame, *, parts: int = 4, entries: int = ENTRIES, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 for every vector that can be coded.

    label_error is the error summed over rows of an equal label, null labels together.
    Vectors that are null or hold null or non-finite components have no row. Null ids come
    last in the choice of first entries, rows of one id count each. Fewer vectors than entries:
    as many entries as vectors. A dimension that the parts don't divide is filled up with zeros.
    Vectors of another dimension than the first one's, empty ones too, have a null code and error.
    Extra columns are ignored; no rows give no rows.
    """
    if not 1 <= entries <= ENTRIES:
        raise ValueError(f"entries must be 1 to {ENTRIES}")
    scratch = tables.Scratch(embeddings.sparkSession)
    rows = scratch.stored(whole_vectors(embeddings, scale))
    books = learn(rows, parts=parts, entries=entries, rounds=rounds)
    coded = scratch.stored(encode(rows, books))
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    few = sums.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    joined = coded.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("of_label")), "left")
    digest = F.lit(books.digest() if books else hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256")
    return scratch.settled(joined.select("vec_id", "code", "error", "label_error", digest))
