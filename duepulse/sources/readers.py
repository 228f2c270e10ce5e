"""Scans of Parquet folders, catalog tables and databases."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_staged(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A table written by ``replace_covered``, with its folder levels as columns."""
    return read_parquet(spark, path, schema)


def time_slices(column: str, start: str, end: str, slices_per_day: int = 1) -> list[str]:
    """Disjoint conditions that cover the inclusive day range, one per database read."""
    first = datetime.fromisoformat(start)
    days = (datetime.fromisoformat(end) - first).days + 1
    step = timedelta(days=1) / slices_per_day
    edges = [first + step * i for i in range(days * slices_per_day + 1)]
    return [
        f"{column} >= '{low.isoformat(sep=' ')}' AND {column} < '{high.isoformat(sep=' ')}'"
        for low, high in zip(edges, edges[1:])
    ]


def key_slices(key: str, slices: int) -> list[str]:
    """Disjoint conditions on a whole-number key or expression, for tables without a time column.

    The expression is the database's: a hash function over a text key will do. Rows whose key is
    NULL come with the first slice. No index serves these conditions, so each slice scans the
    whole table: :func:`key_ranges` is the way where the key has an index.
    """
    # The remainder first: the smallest whole number has no absolute value.
    conditions = [f"abs(mod({key}, {slices})) = {i}" for i in range(slices)]
    return [f"({conditions[0]} OR {key} IS NULL)", *conditions[1:]]


def literal(value: object) -> str:
    """A key's value in the database's SQL: numbers as they are, anything else as a text."""
    if isinstance(value, (int, Decimal)) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def quantile_query(table: str, key: str, slices: int) -> str:
    """A query for the largest key of each of so many equal shares of the rows, as a table.

    An index on the key answers it alone.
    """
    share = f"SELECT {key} AS k, NTILE({slices}) OVER (ORDER BY {key}) AS share FROM {table} WHERE {key} IS NOT NULL"
    return f"(SELECT MAX(k) AS k FROM ({share}) AS shares GROUP BY share) AS bounds"


def key_ranges(key: str, bounds: Iterable[object]) -> list[str]:
    """Disjoint conditions that an index on the key serves: ranges that end at the bounds.

    A bound belongs to the range it ends. The last range is open, so rows that came since are
    read too; rows whose key is NULL are a range of their own. A key that takes up several shares
    of the rows is one bound, and ends one range.
    """
    edges = sorted(set(bounds))
    if not edges:
        return [f"{key} IS NOT NULL", f"{key} IS NULL"]
    told = [literal(edge) for edge in edges[:-1]]
    if not told:
        return [f"{key} IS NOT NULL", f"{key} IS NULL"]
    middle = [f"{key} > {low} AND {key} <= {high}" for low, high in zip(told, told[1:])]
    return [f"{key} <= {told[0]}", *middle, f"{key} > {told[-1]}", f"{key} IS NULL"]


def conformed(rows: DataFrame, schema: StructType) -> DataFrame:
    """The rows with the declared columns in their declared types, by name.

    Other columns stay. A missing column or a type that can't be cast is an error at once.
    """
    missing = [f.name for f in schema.fields if f.name not in rows.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    wrong = [f for f in schema.fields if rows.schema[f.name].dataType != f.dataType]
    return rows.withColumns({f.name: rows[f.name].cast(f.dataType) for f in wrong}) if wrong else rows


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    slices: list[str] | None = None,
    fetch_rows: int = 50_000,
) -> DataFrame:
    """A database table, read in parallel when ``slices`` are given.

    Each slice is one task with its own connection. Equality filters on plain
    columns and the column list go to the database. Connection settings come
    from the caller. Timestamps without a zone stay without one.
    """
    options = {"preferTimestampNTZ": "true", **properties, "fetchsize": str(fetch_rows)}
    if slices:
        return spark.read.jdbc(url, table, predicates=slices, properties=options)
    return spark.read.jdbc(url, table, properties=options)


def read_database_by_key(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str], key: str, slices: int, fetch_rows: int = 50_000
) -> DataFrame:
    """A database table, read by ranges of an indexed key that hold about equally many rows."""
    bounds = read_database(spark, url, quantile_query(table, key, slices), properties).collect()  # a row for each slice
    ranges = key_ranges(key, [row["k"] if "k" in row else row[0] for row in bounds])
    return read_database(spark, url, table, properties, ranges, fetch_rows)
