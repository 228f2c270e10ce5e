"""Exact near-duplicate vectors: a metric range join over cells around pivots.

Vectors are scaled to length 1; a cosine of c is then a distance of sqrt(2 - 2c) = r. Each label's
pivots part its vectors by the nearest pivot. If x has pivot a and y has pivot b, and x and y are
within r, then by the triangle inequality d(y, a) <= d(y, b) + 2r, and also d(y, a) <= r + the
largest distance of a's own vectors from a. So y visits the cells of lower-numbered pivots for
which both hold, and each cell finds its pairs by itself. A cell is worked in blocks of bounded
size, whatever its own; equal vectors are one row with a weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tables
from .components import components

#: Vectors that a cell is meant to hold, and that a block holds on average.
CELL = 1024
#: Pivots of a label, and labels with pivots, at most: the table that is broadcast is bounded.
MOST_PIVOTS = 32
MOST_LABELS = 512


def _units(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and the scaled vector as bytes; null where a vector links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v, label, key in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True):
                x = None
                if v and label is not None and key is not None and None not in v:
                    x = np.array(v, dtype=np.float64)
                    most = np.abs(x).max()
                    x = x / most if np.isfinite(x).all() and most > 0 else None
                out.append(None if x is None else (x / np.sqrt(x @ x)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["vec_id", "label", "unit"])

    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>"))
    return rows.mapInArrow(run, "vec_id long, label string, unit binary")


def _pivots(classes: DataFrame) -> dict[str, np.ndarray]:
    """For the largest labels, up to MOST_PIVOTS vectors each, chosen by hash."""
    sizes = classes.groupBy("label").count().where(F.col("count") > CELL).orderBy(F.desc("count"), "label").limit(MOST_LABELS).collect()
    if not sizes:
        return {}
    wanted = [(label, min(MOST_PIVOTS, -(-n // CELL)) / n) for label, n in sizes]
    share = classes.sparkSession.createDataFrame(wanted, "label string, share double")
    place = F.xxhash64(F.lit(3), "unit").cast("double") / 2.0**64 + 0.5
    chosen = classes.join(F.broadcast(share), "label").where(place < 1.5 * F.col("share")).orderBy(place, "unit")
    found: dict[str, list[np.ndarray]] = {}
    for label, unit in chosen.select("label", "unit").limit(2 * MOST_PIVOTS * len(wanted)).collect():
        found.setdefault(label, []).append(np.frombuffer(unit))
    # Only pivots of the first one's dimension part a label; other dimensions have cells of their own.
    return {k: np.stack([x for x in v if len(x) == len(v[0])][:MOST_PIVOTS]) for k, v in found.items()}


def _distances(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * units @ pivots.T))


def _nearest(batch: pa.RecordBatch, pivots: dict[str, np.ndarray]) -> Iterator[tuple[str, int, np.ndarray, np.ndarray | None]]:
    """For each label and dimension of a batch: the rows, and their distances to its pivots."""
    labels = np.array(batch.column("label").to_pylist(), dtype=object)
    units = batch.column("unit").to_pylist()
    widths = np.array([len(u) // 8 for u in units])
    for label in sorted(set(labels)):
        for width in sorted(set(widths[labels == label])):
            at = np.flatnonzero((labels == label) & (widths == width))
            of = pivots.get(label)
            x = np.stack([np.frombuffer(units[i]) for i in at])
            yield label, int(width), at, _distances(x, of) if of is not None and of.shape[1] == width else None


def find_near_vectors(embeddings: DataFrame, *, least_cosine: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept for every vector.

    Two vectors link when their labels are equal and not null and their cosine, in double
    precision, is at least ``least_cosine``. n_links counts the other vectors linked directly,
    component_id is the smallest vec_id reachable by links, itself included, and kept says that
    it is the vector's own. Every pair is found.

    A vector that is null, empty, zero, or holds a null or non-finite component links with nothing;
    so does one with a null label or of another dimension. Null vec_id: n_links 0, component null,
    kept. Equal vectors link, and each counts. Rows that share a vec_id are vectors of their own,
    each with its own n_links, that share a component. Extra columns are ignored; no rows give no rows.
    """
    radius = float(np.sqrt(2 - 2 * least_cosine))
    scratch = tables.Scratch(embeddings.sparkSession)
    units = scratch.stored(_units(embeddings))
    usable = units.where("unit is not null")
    # Equal vectors of a label are one class, with a number that no other has.
    classes = usable.groupBy("label", "unit").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("m"))
    classes = scratch.stored(classes.withColumn("rep", F.monotonically_increasing_id()))
    context = embeddings.sparkSession.sparkContext
    pivots = context.broadcast(_pivots(classes))

    def radii(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most: dict[tuple[str, int], float] = {}
        for batch in batches:
            for label, _, _, d in _nearest(batch, pivots.value):
                if d is not None:
                    home, near = d.argmin(axis=1), d.min(axis=1)
                    for p in np.unique(home):
                        most[label, int(p)] = max(most.get((label, int(p)), 0.0), float(near[home == p].max()))
        columns = list(zip(*[(k[0], k[1], v) for k, v in most.items()], strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.float64()), strict=True)], names=["label", "pivot", "most"])

    reach = classes.mapInArrow(radii, "label string, pivot int, most double").groupBy("label", "pivot").agg(F.max("most"))
    reached = context.broadcast({(label, p): most for label, p, most in reach.collect()})  # a row for each pivot

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cells, guests = [], [], []
            for label, width, at, d in _nearest(batch, pivots.value):
                if d is None:
                    rows += at.tolist()
                    cells += [f"{label}\0{width}\0"] * len(at)
                    guests += [False] * len(at)
                    continue
                home, near = d.argmin(axis=1), d.min(axis=1)
                for p in range(d.shape[1]):
                    most = reached.value.get((label, p), -1.0)
                    # The rounding of a distance may not cost a visit.
                    visits = (home > p) & (d[:, p] <= near + 2 * radius + 1e-9) & (d[:, p] <= most + radius + 1e-9) & (most >= 0)
                    for mask, guest in ((home == p, False), (visits, True)):
                        rows += at[mask].tolist()
                        cells += [f"{label}\0{width}\0{p}"] * int(mask.sum())
                        guests += [guest] * int(mask.sum())
            index = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells, pa.string()), pa.array(guests, pa.bool_()), batch.column("rep").take(index), batch.column("m").take(index), batch.column("unit").take(index)],
                names=["cell", "guest", "rep", "m", "unit"],
            )

    visits = scratch.stored(classes.mapInArrow(placed, "cell string, guest boolean, rep long, m long, unit binary"))
    found = _blocked(visits).repartition("block").sortWithinPartitions("block").mapInArrow(_paired(least_cosine), "a long, b long, n long")
    found = scratch.stored(found)
    counted = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    links = found.where("b is not null").select("a", "b")
    joined = components(links.unionByName(_of_one_id(usable, classes, scratch))).select(F.col("node").alias("rep"), "component")
    named = classes.join(joined, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    names = named.groupBy("component").agg(F.min("least_id").alias("name"))
    known = named.join(counted, "rep", "left").join(names, "component").select(
        F.col("label").alias("of_label"), F.col("unit").alias("of_unit"),
        (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.col("name").alias("component"),
    )
    on = (units.label == known.of_label) & (units.unit == known.of_unit)
    component = F.coalesce("component", "vec_id")
    result = units.join(known, on, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
    return scratch.settled(result)


def _of_one_id(usable: DataFrame, classes: DataFrame, scratch: tables.Scratch) -> DataFrame:
    """Edges (a, b) between classes that have vectors of one id."""
    several = usable.groupBy("vec_id").agg(F.min(F.struct("label", "unit")).alias("one"), F.max(F.struct("label", "unit")).alias("other"))
    several = scratch.stored(several.where("one <> other").select("vec_id"))
    if several.isEmpty():
        return classes.sparkSession.createDataFrame([], "a long, b long")
    of = usable.join(several, "vec_id").join(classes.select("label", "unit", "rep"), ["label", "unit"]).select("vec_id", "rep").distinct()
    least = of.groupBy("vec_id").agg(F.min("rep").alias("b"))
    return of.join(least, "vec_id").where("rep <> b").select(F.col("rep").alias("a"), "b")


def _blocked(visits: DataFrame) -> DataFrame:
    """Each row in every block pair of its cell that it is needed in.

    A cell's own rows and its guests are dealt by hash into slices; own slices meet one another
    and every guest slice. Own rows that share a block number are the first side of it.
    """
    counts = visits.groupBy("cell").agg(F.count_if(~F.col("guest")).alias("own"), F.count_if("guest").alias("guests"))
    cut = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / CELL)).cast("int")
    counts = counts.select("cell", cut("own").alias("k"), F.when(F.col("guests") > 0, cut("guests")).otherwise(0).alias("g"))
    rows = visits.join(counts, "cell")
    mine = F.pmod(F.xxhash64("rep"), F.when(F.col("guest"), F.col("g")).otherwise(F.col("k"))).cast("int")
    rows = rows.withColumn("mine", mine)

    def block(kind: int, one: Column, other: Column, side: Column) -> Column:
        return F.struct(F.xxhash64("cell", F.lit(kind), one, other).alias("block"), side.alias("side"))

    upto = lambda n: F.sequence(F.lit(0), n - 1)
    m, none = F.col("mine"), F.array().cast("array<struct<block:bigint,side:int>>")
    own = F.transform(upto(F.col("k")), lambda x: block(0, F.least(m, x), F.greatest(m, x), F.when(m <= x, 0).otherwise(1)))
    to_guests = F.when(F.col("g") > 0, F.transform(upto(F.col("g")), lambda x: block(1, m, x, F.lit(0)))).otherwise(none)
    as_guest = F.transform(upto(F.col("k")), lambda x: block(1, x, m, F.lit(1)))
    to = F.when(F.col("guest"), as_guest).otherwise(F.concat(own, to_guests))
    return rows.select(F.explode(to).alias("to"), "rep", "m", "unit").select("to.block", "to.side", "rep", "m", "unit")


def _paired(least_cosine: float):  # noqa: ANN202
    def work(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids; the smallest id that each one's links lead to in this block; linked vectors of each."""
        held.sort(key=lambda row: row[2])
        ids = np.array([row[2] for row in held], dtype=np.int64)
        side = np.array([row[1] for row in held])
        m = np.array([row[3] for row in held], dtype=np.int64)
        x = np.stack([np.frombuffer(row[4]) for row in held])
        links = x @ x.T >= least_cosine
        np.fill_diagonal(links, False)
        if side.any():
            links &= side[:, None] != side[None, :]
        label, numbers = np.arange(len(ids)), np.arange(len(ids))
        seen = links | (numbers[:, None] == numbers[None, :])
        while True:
            after = np.where(seen, label[None, :], len(ids)).min(axis=1)
            after = after[after]
            if (after == label).all():
                return ids, ids[label], links @ m
            label = after

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[tuple]) -> pa.RecordBatch:
            a, b, n = work(held)
            some = n > 0
            return pa.RecordBatch.from_arrays(
                [pa.array(a[some]), pa.array(b[some], mask=(a == b)[some]), pa.array(n[some])], names=["a", "b", "n"]
            )

        group, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != group:
                    if len(held) > 1:
                        yield out(held)
                    group, held = row[0], []
                held.append(row)
        if len(held) > 1:
            yield out(held)

    return run
