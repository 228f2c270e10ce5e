"""Loads into a database that can be repeated: staged by tasks, moved over in one transaction.

Tasks append rows to a staging table, each row with the load's id and a number of its own. A task
that runs twice stages its rows twice, under the same numbers. Once all tasks are done, one
transaction inside the database takes each number once, and puts the load on record; a load that
is on record is not moved again. So neither a lost executor nor a repeated load adds a row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from duepulse.sources.writers import Loaded, save_mode

#: Columns of the staging table beside the target's own.
LOAD, ROW = "load_id", "load_row"

Execute = Callable[[list[str]], None]


def quoted(name: str) -> str:
    """An identifier, parts of a qualified one apart."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@dataclass(frozen=True)
class Load:
    """One load of ``columns`` into ``table``.

    ``covered`` is the condition on rows that the load stands for, in the database's SQL: with
    ``replace`` they go in the same transaction (all rows without a condition), with ``fail`` the
    load is refused where there are some.
    """

    table: str
    columns: tuple[str, ...]
    load_id: str
    if_exists: str = "append"
    covered: str | None = None

    def __post_init__(self) -> None:
        save_mode(self.if_exists)
        if {LOAD, ROW} & set(self.columns):
            raise ValueError(f"{LOAD} and {ROW} are the staging table's own columns")

    @property
    def staging(self) -> str:
        return f"{self.table}_staging"

    @property
    def ledger(self) -> str:
        return f"{self.table}_loads"

    def preparation(self) -> list[str]:
        """Makes the record of loads and clears what an earlier attempt of this load has staged."""
        return [
            f"CREATE TABLE IF NOT EXISTS {quoted(self.ledger)} ({LOAD} VARCHAR(200) PRIMARY KEY, load_rows BIGINT NOT NULL)",
            f"DELETE FROM {quoted(self.staging)} WHERE {LOAD} = {literal(self.load_id)}",
        ]

    def transaction(self) -> list[str]:
        """Moves the staged rows over. To be run as one transaction; run again, it changes nothing."""
        own = ", ".join(map(quoted, self.columns))
        mine = f"{LOAD} = {literal(self.load_id)}"
        new = f"NOT EXISTS (SELECT 1 FROM {quoted(self.ledger)} WHERE {mine})"
        once = f"SELECT {own}, ROW_NUMBER() OVER (PARTITION BY {ROW} ORDER BY {ROW}) AS load_copy FROM {quoted(self.staging)} WHERE {mine}"
        statements = []
        where = f"({self.covered}) AND " if self.covered else ""
        if self.if_exists == "replace":
            statements.append(f"DELETE FROM {quoted(self.table)} WHERE {where}{new}")
        elif self.if_exists == "fail":
            # The record refuses a NULL, which ends the transaction where rows are there.
            statements.append(
                f"INSERT INTO {quoted(self.ledger)} SELECT {literal(self.load_id)}, CAST(NULL AS BIGINT) FROM {quoted(self.table)} WHERE {where}{new}"
            )
        return [
            *statements,
            f"INSERT INTO {quoted(self.table)} ({own}) SELECT {own} FROM ({once}) AS staged WHERE load_copy = 1 AND {new}",
            f"INSERT INTO {quoted(self.ledger)} SELECT {literal(self.load_id)}, COUNT(DISTINCT {ROW}) FROM {quoted(self.staging)} WHERE {mine} HAVING {new}",
            f"DELETE FROM {quoted(self.staging)} WHERE {mine}",
        ]


def staged(rows: DataFrame, load: Load) -> DataFrame:
    """The rows as they are staged, numbered.

    A number is the row's partition and place, so the rows must be those of a written table:
    a task that is repeated then finds the same rows in the same places.
    """
    return rows.select(*load.columns).withColumns({LOAD: F.lit(load.load_id), ROW: F.monotonically_increasing_id()})


def in_transaction(spark: SparkSession, url: str, properties: Mapping[str, str]) -> Execute:
    """Runs statements as one transaction over a connection of the driver's."""

    def execute(statements: list[str]) -> None:
        settings = spark._jvm.java.util.Properties()
        for key, value in properties.items():
            settings.setProperty(key, value)
        connection = spark._jvm.java.sql.DriverManager.getConnection(url, settings)
        try:
            connection.setAutoCommit(False)
            for statement in statements:
                connection.createStatement().executeUpdate(statement)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    return execute


def load_database(
    rows: DataFrame, url: str, properties: Mapping[str, str], load: Load, *,
    execute: Execute | None = None, batch_rows: int = 20_000, connections: int = 16,
) -> Loaded:
    """Loads a written table (see :func:`staged`) over at most ``connections`` connections.

    The staging table comes into being with the first load and stays, empty between loads.
    """
    spark = rows.sparkSession
    execute = execute or in_transaction(spark, url, properties)
    options = {**properties, "batchsize": str(batch_rows)}
    numbered = staged(rows, load)
    numbered.limit(0).write.jdbc(url, load.staging, mode="append", properties=options)
    execute(load.preparation())
    count = rows.count()
    # Fewer tasks at once, without a shuffle: the numbers depend on the partitions.
    numbered.coalesce(connections).write.jdbc(url, load.staging, mode="append", properties=options)
    execute(load.transaction())
    return Loaded(count)
