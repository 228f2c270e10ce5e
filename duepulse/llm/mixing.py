"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tables


@dataclass(frozen=True)
class Mix:
    #: Weights of the sources by code point, null last, repeating.
    weights: tuple[float, ...] = (5, 2, 1)
    #: Words wanted, as a share of all there are.
    share: float = 1.5
    #: How often a word can be taken.
    repeats: int = 2
    block_words: int = 64
    shard_words: int = 1 << 20
    #: Shards, or groups of them, that one task shares a quota out to.
    fan: int = 1024
    seed: int = 7


def targets(sizes: np.ndarray, mix: Mix) -> np.ndarray:
    """Words wanted of each source: by weight, none above repeats times its size.

    What a source can't give is shared among the others by weight until none is above.
    """
    weight = np.resize(np.array(mix.weights, dtype=float), len(sizes))
    most = mix.repeats * sizes.astype(float)
    out, free, left = np.zeros(len(sizes)), np.ones(len(sizes), dtype=bool), mix.share * float(sizes.sum())
    while free.any():
        out[free] = left * weight[free] / weight[free].sum()
        over = free & (out > most)
        if not over.any():
            break
        out[over] = most[over]
        left -= float(most[over].sum())
        free &= ~over
    return out


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by the highest quotients votes / (2 * seats held + 1), none above its most.

    The divisor is searched, as seats can be many; seats that it leaves open on ties go one by
    one to the highest quotients, equal ones to the first.
    """
    votes = votes.astype(float)
    seats = int(min(seats, most[votes > 0].sum()))

    def at(divisor: float) -> np.ndarray:
        return np.minimum(np.floor(votes / divisor + 0.5), most).astype(np.int64)

    if seats <= 0:
        return np.zeros(len(votes), dtype=np.int64)
    low, high = votes[votes > 0].min() / (2.0 * float(most.max()) + 2), 4 * votes.max()  # all seats and none
    for _ in range(200):
        middle = (low * high) ** 0.5
        low, high = (middle, high) if at(middle).sum() > seats else (low, middle)
    held = at(high)
    while held.sum() < seats:
        quotient = np.where(held < most, votes / (2 * held + 1), -1)
        held[int(np.argmax(quotient))] += 1
    return held


def _sized(documents: DataFrame, keep: list[str]) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source"),
        F.regexp_count(text, F.lit(tables.WORD)).cast("long").alias("size"),
        F.xxhash64(text).alias("tie"), *[F.col(c).alias(f"kept_{c}") for c in keep],
    )


def _quotas(cells: DataFrame, shards: int, mix: Mix) -> DataFrame:
    """(source, shard, cell_words, cut, quota) of cells (source, shard, blocks, cell_words).

    A source's blocks go to its shards by highest quotients. Where it has more than ``fan`` shards
    they go to groups of so many first, and to groups of groups before that, so that no task shares
    out to more than ``fan`` at once, whatever the source's size.
    """
    cut = F.greatest(F.lit(1), F.rint(F.col("cell_words") / mix.block_words)).cast("long")
    cells = cells.withColumn("cut", cut).withColumn("most", F.when(F.col("cell_words") > 0, mix.repeats * F.col("cut")).otherwise(0))
    heights = 1
    while mix.fan**heights < shards:
        heights += 1

    def shared_out(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        votes, most = rows["words"].to_numpy(), rows["most"].to_numpy()
        quota = sainte_lague(votes, int(rows["blocks"][0].as_py()), most)
        return pa.table([rows["source"], rows["node"], pa.array(quota, pa.int64())], names=["source", "node", "quota"])

    above = None
    for height in reversed(range(heights)):
        node = F.floor(F.col("shard") / mix.fan**height).cast("long")
        level = cells.groupBy("source", node.alias("node")).agg(
            F.sum("cell_words").alias("words"), F.sum("most").cast("long").alias("most"), F.first("blocks").alias("blocks")
        ).withColumn("parent", F.floor(F.col("node") / mix.fan).cast("long"))
        if above is not None:
            up = above.withColumnsRenamed({"source": "of", "node": "of_node"})
            level = level.drop("blocks").join(up, level.source.eqNullSafe(up.of) & (level.parent == up.of_node))
            level = level.drop("of", "of_node").withColumnRenamed("quota", "blocks")
        above = level.groupBy("source", "parent").applyInArrow(shared_out, "source string, node long, quota long")
    shared = above.withColumnsRenamed({"source": "of", "node": "of_node"})
    return cells.join(shared, cells.source.eqNullSafe(shared.of) & (cells.shard == shared.of_node)).select(
        "source", "shard", "cell_words", "cut", "quota"
    )


def _selected(cells: DataFrame, shards: int, mix: Mix) -> DataFrame:
    """Which blocks of each cell are taken: all ``every`` times, and ``extra`` of them once more.

    These are the first in an order that steps through the cell's blocks by a seeded step.
    """
    schema = "source string, shard long, cell_words long, cut long, every long, extra long, step long, first long"

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            steps, starts = [], []
            for source, shard, n in zip(rows["source"], rows["shard"], rows["cut"], strict=True):
                rng = np.random.default_rng([mix.seed, zlib.crc32(str(source).encode()), shard])
                step = int(rng.integers(1, n + 1))
                while gcd(step, n) != 1:
                    step += 1
                steps.append(step)
                starts.append(int(rng.integers(0, n)))
            cut, quota = batch["cut"].to_numpy(), batch["quota"].to_numpy()
            columns = [batch["source"], batch["shard"], batch["cell_words"], batch["cut"], quota // cut, quota % cut, steps, starts]
            names = ["source", "shard", "cell_words", "cut", "every", "extra", "step", "first"]
            yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names=names)

    # Written between, so that no task runs two Python steps, each in a worker that stays.
    return tables.stored(_quotas(cells, shards, mix)).mapInArrow(seeded, schema)


def _plan(documents: DataFrame, mix: Mix, keep: list[str]) -> DataFrame:
    """Each document with its place in its cell and the cell's block selection.

    A cell is a shard of a source: its documents in seeded order are one stream of words, cut
    into blocks of equal length. The cell has a quota of blocks; every block is taken
    quota div blocks times, and those first in a seeded order once more.
    """
    spark = documents.sparkSession
    sizes = tables.stored(_sized(documents, []))
    found = sizes.groupBy("source").agg(F.sum("size").alias("words")).collect()  # a row for each source
    found.sort(key=lambda r: (r[0] is None, r[0] or ""))
    words = np.array([r[1] for r in found], dtype=np.int64)
    wanted = targets(words, mix)
    shards = [max(1, ceil(int(n) / mix.shard_words)) for n in words]
    most = mix.repeats * np.maximum(1, np.round(words / mix.block_words)).astype(np.int64) * (words > 0)
    blocks = sainte_lague(wanted, round(float(wanted.sum()) / mix.block_words), most)
    # A source that is wanted whole is taken whole, whatever its blocks round to.
    blocks = np.where(wanted >= mix.repeats * words, np.int64(1) << 60, blocks)
    # As an Arrow table: from a list of rows, Spark makes them in Python workers of their own, which stay.
    columns = [pa.array([r[0] for r in found], pa.string()), words, wanted, pa.array(shards, pa.int64()), blocks]
    known = spark.createDataFrame(
        pa.table([pa.array(c) for c in columns], names=["source", "source_size", "target", "shards", "blocks"]),
        "source string, source_size long, target double, shards long, blocks long",
    )

    def sharded(df: DataFrame) -> DataFrame:
        k = known.withColumnRenamed("source", "of")
        place = F.pmod(F.xxhash64(F.lit(mix.seed), "doc_id", "tie"), F.col("shards"))
        return df.join(k, df.source.eqNullSafe(k.of)).drop("of").withColumn("shard", place)

    cells = sharded(sizes).groupBy("source", "shard", "blocks").agg(F.sum("size").alias("cell_words"))
    selected = _selected(tables.stored(cells), max(shards, default=1), mix).withColumnsRenamed({"source": "of", "shard": "of_shard"})
    stream = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(mix.seed + 1), "doc_id", "tie"), "doc_id", "tie", "size")
    placed = sharded(_sized(documents, keep) if keep else sizes).withColumn(
        "at", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    )
    on = placed.source.eqNullSafe(selected.of) & (placed.shard == selected.of_shard)
    return placed.join(selected, on).drop("of", "of_shard")


def _overlaps() -> Column:
    """For each extra block that a document's words lie in: from and to which word of it, from 0."""
    spans = F.expr(
        "transform(filter(sequence(((at + 1) * cut - 1) div cell_words, ((at + size) * cut - 1) div cell_words), "
        "i -> pmod(i * step + first, cut) < extra), "
        "i -> named_struct('low', greatest(i * cell_words div cut, at) - at, "
        "'high', least((i + 1) * cell_words div cut, at + size) - at))"
    )
    return F.when((F.col("size") > 0) & (F.col("extra") > 0), spans).otherwise(F.expr("array()").cast("array<struct<low:bigint,high:bigint>>"))


def mix_sources(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words, repeats counted) of each document.

    Size is the number of runs without white space. Targets are by :func:`targets`. Blocks of
    ``block_words`` go to sources by highest quotients and within a source to its shards the same
    way; which blocks of a shard are taken is a seeded choice that reruns repeat.

    Null or empty text: size 0, taken 0. A null source is a source of its own, last. Null and
    repeated doc_ids: each row is taken for itself, equal rows in any order. No rows give no rows.
    Sources are few enough that one row for each fits the driver. Extra columns are ignored.
    """
    extra = F.aggregate(_overlaps(), F.lit(0).cast("long"), lambda n, s: n + s["high"] - s["low"])
    return _plan(documents, mix, []).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("every") * F.col("size") + extra).alias("taken")
    )


def mixed_documents(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents as the mix takes them, with the columns of ``documents``.

    A document taken whole comes once for each time; words taken once more, by blocks, come as one
    further row that has these words, each with the white space before it. Documents that nothing
    is taken of, such as those without words, are gone. n_chars, where there is one, is that of the new text.
    """
    keep = [c for c in documents.columns if c not in ("doc_id", "source")]
    plan = _plan(documents, mix, keep).where("size > 0")
    whole = F.array_repeat(F.col("kept_text"), F.col("every").cast("int"))
    parts = F.regexp_extract_all("kept_text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    spans = _overlaps()
    some = F.concat_ws("", F.flatten(F.transform(spans, lambda s: F.slice(parts, (s["low"] + 1).cast("int"), (s["high"] - s["low"]).cast("int")))))
    all_of_it = (F.size(spans) > 0) & (F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["high"] - s["low"]) == F.col("size"))
    more = F.when(F.size(spans) == 0, F.expr("array()").cast("array<string>")).when(all_of_it, F.array("kept_text")).otherwise(F.array(some))
    taken = plan.withColumn("new", F.explode(F.concat(whole, more)))
    new = {"text": F.col("new"), "n_chars": F.length("new").cast("long")}
    columns = [F.col(c) if c in ("doc_id", "source") else new.get(c, F.col(f"kept_{c}")) for c in documents.columns]
    return taken.select(*[c.alias(n) for c, n in zip(columns, documents.columns, strict=True)])
