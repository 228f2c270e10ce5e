"""Sinks: append, replace or refuse; and replacement of the partitions a run covers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

_MODES = {"append": "append", "replace": "overwrite", "fail": "error"}


@dataclass(frozen=True)
class Loaded:
    """What a write did: its rows, and how many of them each named condition holds for."""

    rows: int
    by_name: dict[str, int] = field(default_factory=dict)

    @property
    def any_rows(self) -> bool:
        return self.rows > 0


def save_mode(if_exists: str) -> str:
    if if_exists not in _MODES:
        raise ValueError(f"if_exists must be one of {sorted(_MODES)}, not {if_exists!r}")
    return _MODES[if_exists]


def _counted(rows: DataFrame, **named: Column) -> tuple[DataFrame, Observation]:
    """The rows with counts taken during the write, so no second scan is needed."""
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in named.items()]]
    return rows.observe(seen, *counts), seen


def write_parquet(rows: DataFrame, path: str, if_exists: str = "append") -> Loaded:
    counted, seen = _counted(rows)
    counted.write.mode(save_mode(if_exists)).parquet(path)
    return Loaded(seen.get["rows"])


def write_catalog(rows: DataFrame, name: str, if_exists: str = "append") -> Loaded:
    """Into a catalog table; columns bind by name."""
    counted, seen = _counted(rows)
    counted.write.mode(save_mode(if_exists)).format("parquet").saveAsTable(name)
    return Loaded(seen.get["rows"])


def write_database(
    rows: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    if_exists: str = "append",
    batch_rows: int = 20_000,
    connections: int = 16,
) -> Loaded:
    """Into a database table over ``connections`` connections.

    The shuffle before keeps the work behind the rows on all cores. A retried task inserts its rows
    again: :func:`duepulse.sources.loads.load_database` doesn't.
    """
    counted, seen = _counted(rows.repartition(connections))
    counted.write.jdbc(
        url, table, mode=save_mode(if_exists), properties={**properties, "batchsize": str(batch_rows)}
    )
    return Loaded(seen.get["rows"])


def encoded(text: Column) -> Column:
    """A text as a folder name: never empty, no special characters, NULL and '' apart."""
    return F.coalesce(F.concat(F.lit("v"), F.hex(F.encode(text, "utf-8"))), F.lit("n"))


def encoded_value(text: str | None) -> str:
    """What ``encoded`` gives for this text."""
    return "n" if text is None else f"v{text.encode().hex().upper()}"


@dataclass(frozen=True)
class Covered:
    """The part of a table that a run stands for, by the first two folder levels.

    ``first`` tells of a folder's value whether it is covered, ``second`` is the one covered
    value; None covers all.
    """

    first: Callable[[str], bool] | None = None
    second: str | None = None


def _remove(spark: SparkSession, path: str, parts: tuple[str, ...], covered: Covered) -> None:
    """Removes the covered folders. Lists the first level only, whose values are days or months."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(conf)
    if covered.first is None and covered.second is None:
        files.delete(root, True)
    elif files.exists(root):
        for status in files.listStatus(root):
            name, _, value = status.getPath().getName().partition("=")
            if name != parts[0] or not (covered.first is None or covered.first(value)):
                continue
            folder = status.getPath()
            if covered.second is not None:
                folder = jvm.org.apache.hadoop.fs.Path(folder, f"{parts[1]}={covered.second}")
            files.delete(folder, True)
    files.mkdirs(root)


def replace_covered(
    rows: DataFrame, path: str, parts: dict[str, Column], covered: Covered, **named: Column
) -> Loaded:
    """Replaces what the table holds for a run, so that a second run changes nothing.

    ``parts`` are the folder levels, as columns beside the table's own, which stay in the files as
    they are. All rows must lie in the covered part. It is removed, then the rows are appended: one
    job whatever the number of partitions, and nothing about them is gathered on the driver. This
    is for plain folders that other programs read; a run that dies half-way leaves the covered part
    empty until it is repeated. :class:`duepulse.sources.versions.VersionedTable` replaces in one step.

    A rebalance brings the rows of a partition together and cuts them into several files where
    they are many. ``named`` conditions are counted along.
    """
    _remove(rows.sparkSession, path, tuple(parts), covered)
    even = rows.withColumns(parts).hint("rebalance", *[F.col(p) for p in parts])
    counted, seen = _counted(even, **named)
    counted.write.mode("append").partitionBy(*parts).parquet(path)
    counts = dict(seen.get)
    return Loaded(counts.pop("rows"), counts)


def write_clustered(rows: DataFrame, path: str, by: Sequence[str], if_exists: str = "append", files: int | None = None) -> Loaded:
    """Parquet files that hold ranges of the columns ``by``, sorted, with Bloom filters on them.

    A scan for one value then skips files and row groups by their smallest and largest values, and
    those that have the value in their range but not in them by the filter. The ranges come from a
    sample; a value with very many rows is spread over files where a further column parts it.
    """
    columns = [F.col(c) for c in by]
    even = rows.repartitionByRange(files, *columns) if files else rows.repartitionByRange(*columns)
    counted, seen = _counted(even.sortWithinPartitions(*columns))
    writer = counted.write.mode(save_mode(if_exists))
    for c in by[:1]:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
    return Loaded(seen.get["rows"])
