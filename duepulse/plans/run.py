"""A full run: extract, aggregate and report into versioned Parquet tables.

Every step reads tables the earlier steps wrote, so no lineage spans steps
and a lost executor costs the running step's tasks only. A table changes in one
step once a write is whole. Each run and its writes are on record, so that a run
that died is told from a finished one, and taken up where it stopped.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from duepulse import schemas, session
from duepulse.functions.measures import day_of
from duepulse.operators.aggregate import aggregate_ivr, aggregate_messages
from duepulse.operators.extract import (
    extract_allocation,
    extract_ivr,
    extract_messages,
    extract_tags,
)
from duepulse.operators import loan_days, rollup
from duepulse.operators.scope import IVR_CHANNEL, MESSAGE_CHANNELS, Scope
from duepulse.plans import reports
from duepulse.sources.readers import conformed
from duepulse.sources.versions import EVERYWHERE, Region, VersionedTable
from duepulse.sources.writers import Loaded, encoded, encoded_value, save_mode


@dataclass(frozen=True)
class Sources:
    communication: DataFrame
    lending_default_details: DataFrame
    lending_loan_details: DataFrame
    tags: DataFrame
    click_data: DataFrame


@dataclass(frozen=True)
class Table:
    """A table of the run: its columns, and the folder levels its files are in.

    Parts are columns beside the table's own, in a form that prunes files: a day in place of a
    timestamp or a text, an encoded text that is never empty. The first level is a day or month,
    so a run finds what it covers by the names of few folders.
    """

    name: str
    parts: tuple[str, ...]
    schema: StructType | None

    def at(self, spark: SparkSession, root: str) -> VersionedTable:
        parts = tuple((part, PARTS[part][0]) for part in self.parts)
        return VersionedTable(spark, f"{root.rstrip('/')}/{self.name}", parts, self.schema)


# Folder levels: type and definition.
PARTS: dict[str, tuple[str, Callable[[], Column]]] = {
    "part_company": ("string", lambda: encoded(F.col("company_id"))),
    "part_month": ("string", lambda: encoded(F.col("allocation_month"))),
    "part_channel": ("string", lambda: encoded(F.lower("type_of_comm"))),
    "part_created": ("date", lambda: F.to_date("created")),
    "part_started": ("date", lambda: day_of(F.col("start_time"))),
    "part_date": ("date", lambda: F.col("date")),
    "part_created_day": ("date", lambda: F.col("created_day")),
}

_MONTHLY = ("part_month", "part_company")
ALLOCATION_DATA = Table("allocation_data", _MONTHLY, None)
TAG_DATA = Table("tag_data", _MONTHLY, schemas.TAG_DATA)
MSG_DATA = Table("msg_data", ("part_created", "part_company", "part_channel"), schemas.MSG_DATA)
IVR_DATA = Table("ivr_data", ("part_created", "part_company", "part_started"), schemas.IVR_DATA)
MSG_AGG_DATA = Table("msg_agg_data", ("part_created", "part_company"), schemas.MSG_AGG_DATA)
IVR_AGG_DATA = Table("ivr_agg_data", ("part_started", "part_company", "part_created"), schemas.IVR_AGG_DATA)
# One row per day a message or call was created, whatever the day it is reported under, so that
# runs over overlapping days replace each other's.
CHANNEL_AGG_OVERVIEW = Table(
    "channel_agg_overview", ("part_created_day", "part_company"), schemas.OVERVIEW_BY_CREATED_DAY
)
_DAILY = ("part_date", "part_company")
# What three reports are made from.
RESPONSE_SUMS = Table("response_sums", _DAILY, schemas.RESPONSE_SUMS)
CHANNEL_CONNECTIVITY_RESPONSE = Table("channel_connectivity_response", _DAILY, schemas.CHANNEL_RESPONSE)
DATEWISE_CHANNEL_RESPONSE = Table("datewise_channel_response", _DAILY, schemas.CHANNEL_RESPONSE)
HOURWISE_CHANNEL_RESPONSE = Table("hourwise_channel_response", _DAILY, schemas.HOURWISE_CHANNEL_RESPONSE)
TABLES = (
    ALLOCATION_DATA,
    TAG_DATA,
    IVR_DATA,
    MSG_DATA,
    MSG_AGG_DATA,
    IVR_AGG_DATA,
    CHANNEL_AGG_OVERVIEW,
    CHANNEL_CONNECTIVITY_RESPONSE,
    DATEWISE_CHANNEL_RESPONSE,
    HOURWISE_CHANNEL_RESPONSE,
)


#: All tables that a run writes, in their order.
WRITTEN = (*TABLES[:7], RESPONSE_SUMS, *TABLES[7:])
_RUNS = "_runs"


@dataclass(frozen=True)
class Run:
    """Tables under ``root`` for the companies, days and month of a run.

    ``if_exists`` says what becomes of rows that are there for what the run covers: replaced
    (so a second run changes nothing), kept beside the new ones (append), or a reason to refuse
    (fail). A run that is resumed leaves out the tables that it wrote already.
    """

    spark: SparkSession
    root: str
    scope: Scope
    allocation_month: str | None = None
    if_exists: str = "replace"
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    resumed: bool = False

    def __post_init__(self) -> None:
        session.require(self.spark)
        save_mode(self.if_exists)

    @classmethod
    def resume(cls, spark: SparkSession, root: str, run_id: str) -> Run:
        """The run of this id, as it was begun under ``root``."""
        told = next((r for r in _begun(spark, root) if r["run_id"] == run_id), None)
        if told is None:
            raise ValueError(f"no run {run_id} was begun under {root}")
        scope = Scope(told["company_id"], told["first_day"], told["last_day"])
        return cls(spark, root, scope, told["allocation_month"], told["if_exists"], run_id, resumed=True)

    def begin(self) -> None:
        """Puts the run on record before it writes anything."""
        told = {
            "run_id": self.run_id, "company_id": self.scope.company_id, "first_day": self.scope.start,
            "last_day": self.scope.end, "allocation_month": self.allocation_month, "if_exists": self.if_exists,
        }
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root.rstrip('/')}/{_RUNS}/{self.run_id}.json")
        stream = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        try:
            stream.write(bytearray(json.dumps(told).encode()))
        finally:
            stream.close()

    def _at(self, table: Table) -> VersionedTable:
        return table.at(self.spark, self.root)

    def read(self, table: Table) -> DataFrame:
        """The whole table as it was declared, all runs included."""
        stored = self._at(table).read()
        if table.schema is None:
            return stored.drop(*table.parts)
        rows = stored.select(*table.schema.names)
        return rollup.overview_totals(rows) if table is CHANNEL_AGG_OVERVIEW else rows

    def read_days(self, table: Table, part: str | None = None, every_company: bool = False) -> DataFrame:
        """The days of this run, and its company, picked by folder."""
        part = part or table.parts[0]
        region = self._days(every_company) if part == table.parts[0] else EVERYWHERE
        rows = self._at(table).read(region).where(self.scope.days(F.col(part)))
        if self.scope.company_id is not None and not every_company:
            rows = rows.where(F.col("part_company") == encoded_value(self.scope.company_id))
        return rows.select(*table.schema.names)

    def write(self, table: Table, rows: DataFrame, region: Region) -> Loaded:
        stored = self._at(table)
        if self.resumed and (before := stored.write_of(self.run_id)):
            return before.loaded()
        parts = {name: PARTS[name][1]() for name in table.parts}
        named = {}
        if table is MSG_DATA:  # whether messages came is told for each channel
            named = {channel: F.lower("type_of_comm") == channel for channel in MESSAGE_CHANNELS}
        # Tables that only later steps of the run read are its own to replace.
        mode = "replace" if table is RESPONSE_SUMS else self.if_exists
        return stored.replace(rows, parts, region, self.run_id, mode, **named)

    def _company(self) -> str | None:
        company = self.scope.company_id
        return None if company is None else encoded_value(company)

    def _days(self, every_company: bool = False) -> Region:
        return Region(self.scope.start, self.scope.end, None if every_company else self._company())

    def _month(self) -> Region:
        month = None if self.allocation_month is None else encoded_value(self.allocation_month)
        return Region(month, month, self._company())

    def _write_all(self, steps: list[tuple[Table, DataFrame, Region]]) -> dict[str, Loaded]:
        """Independent tables at the same time, so that one's last tasks leave no core idle."""
        with ThreadPoolExecutor(len(steps)) as pool:
            write = inheritable_thread_target(self.spark)(self.write)
            written = {step[0].name: pool.submit(write, *step) for step in steps}
            return {name: result.result() for name, result in written.items()}

    def extract(self, sources: Sources) -> dict[str, Loaded]:
        scope, month = self.scope, self.allocation_month
        defaults, details = sources.lending_default_details, sources.lending_loan_details
        communication = conformed(sources.communication, schemas.COMMUNICATION)
        tags = conformed(sources.tags, schemas.TAGS)
        return self._write_all(
            [
                (ALLOCATION_DATA, extract_allocation(defaults, details, scope, month), self._month()),
                (TAG_DATA, extract_tags(tags, scope, month), self._month()),
                (IVR_DATA, extract_ivr(communication, scope), self._days()),
                (MSG_DATA, extract_messages(communication, scope), self._days()),
            ]
        )

    def aggregate(self, bad_durations: str = "fail") -> dict[str, Loaded]:
        """Messages of the run's companies; calls of every company loaded."""
        scope = self.scope
        messages = aggregate_messages(self.read_days(MSG_DATA), scope)
        started = self.read_days(IVR_DATA, "part_started", every_company=True)
        calls = aggregate_ivr(started, scope, IVR_CHANNEL, bad_durations)
        return self._write_all(
            [
                (MSG_AGG_DATA, messages, self._days()),
                (IVR_AGG_DATA, calls, self._days(every_company=True)),
            ]
        )

    def report(self, click_data: DataFrame) -> dict[str, Loaded]:
        """The overview from the aggregates; the other three from one table of sums."""
        click_data = conformed(click_data, schemas.CLICK_DATA)
        scope, tags = self.scope, self.read(TAG_DATA)
        messages, calls = self.read_days(MSG_AGG_DATA), self.read_days(IVR_AGG_DATA)
        # The overview picks calls by the day they were created.
        created = self.read_days(IVR_AGG_DATA, "part_created")
        overview = reports.channel_overview(messages, created, tags, scope, by_created_day=True)
        levels = loan_days.loan_levels(
            loan_days.message_rows(messages, scope).unionByName(loan_days.call_rows(calls, scope))
        )
        sums = reports.response_sums(levels, tags, click_data, scope)
        first = self._write_all([(CHANNEL_AGG_OVERVIEW, overview, self._days()), (RESPONSE_SUMS, sums, self._days())])
        first.pop(RESPONSE_SUMS.name)
        sums = self.read_days(RESPONSE_SUMS)
        return first | self._write_all(
            [
                (CHANNEL_CONNECTIVITY_RESPONSE, rollup.response_of_sums(sums, "max"), self._days()),
                (DATEWISE_CHANNEL_RESPONSE, rollup.response_of_sums(sums, "sum"), self._days()),
                (HOURWISE_CHANNEL_RESPONSE, rollup.response_of_sums(sums, "sum", by_hour=True), self._days()),
            ]
        )

    def all(self, sources: Sources, bad_durations: str = "fail") -> dict[str, Loaded]:
        if not self.resumed:
            self.begin()
        return {
            **self.extract(sources),
            **self.aggregate(bad_durations),
            **self.report(sources.click_data),
        }


def _begun(spark: SparkSession, root: str) -> list[dict]:
    """What the runs that were begun under ``root`` put on record."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{_RUNS}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    told = []
    for status in files.listStatus(folder) if files.exists(folder) else []:
        stream = files.open(status.getPath())
        try:
            told.append(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()
    return told


LEDGER = (
    "run_id string, company_id string, first_day string, last_day string, allocation_month string, if_exists string, "
    "finished boolean, table_name string, written boolean, table_rows long, by_channel map<string, long>"
)


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """A row for each run under ``root`` and table it writes: whether it wrote it, and what came.

    ``finished`` says whether the run wrote all its tables. Rows are those of the write, whether or
    not a later run replaced them. The records are one for each run and table, not for their rows.
    """
    writes = {(w.run, t.name): w for t in WRITTEN for w in t.at(spark, root).history()}
    rows = []
    for told in _begun(spark, root):
        of = [writes.get((told["run_id"], t.name)) for t in WRITTEN]
        for table, write in zip(WRITTEN, of, strict=True):
            done = (True, write.rows, dict(write.by_name)) if write else (False, None, None)
            rows.append((*(told[k] for k in ("run_id", "company_id", "first_day", "last_day", "allocation_month", "if_exists")),
                         all(of), table.name, *done))
    return spark.createDataFrame(rows, LEDGER)
