"""Versioned tables: replacement in one step, open columns, writers at once, the record of runs."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from told import SF_SMALL, rows_of
from duepulse.operators.scope import Scope
from duepulse.plans import run
from duepulse.sources import sample
from duepulse.sources.versions import EVERYWHERE, Region, VersionedTable, merged
from duepulse.sources.writers import encoded, encoded_value

SCHEMA = "day date, company string, v int"
PARTS = (("part_day", "date"), ("part_company", "string"))


def parts():
    return {"part_day": F.col("day"), "part_company": encoded(F.col("company"))}


def table(spark, path, schema=SCHEMA):
    return VersionedTable(spark, str(path), PARTS, None if schema is None else StructType.fromDDL(schema))


def rows(spark, *told):
    made = [(date(2024, 1, d) if d else None, c, v) for d, c, v in told]
    return spark.createDataFrame(made, SCHEMA)


def days(first, last, company=None):
    return Region(f"2024-01-{first:02}", f"2024-01-{last:02}", None if company is None else encoded_value(company))


def values(stored, region=EVERYWHERE):
    return sorted(r.v for r in stored.read(region).collect())


def test_a_write_that_dies_changes_nothing(spark, tmp_path):
    stored = table(spark, tmp_path)
    stored.replace(rows(spark, (1, "a", 1), (2, "a", 2), (3, "a", 3)), parts(), EVERYWHERE)
    dies = rows(spark, (1, "a", 10), (2, "a", 20)).withColumn("v", F.when(F.col("v") == 20, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        stored.replace(dies, parts(), days(1, 2))
    assert values(stored) == [1, 2, 3]
    done = stored.replace(rows(spark, (2, "a", 20)), parts(), days(1, 2))
    assert done.rows == 1
    assert values(stored) == [3, 20]  # the first day is covered and got no rows


def test_readers_keep_what_they_saw_until_the_vacuum(spark, tmp_path):
    stored = table(spark, tmp_path)
    assert values(stored) == [] and stored.read().columns == ["day", "company", "v", "part_day", "part_company"]
    stored.replace(rows(spark, (1, "a", 1)), parts(), EVERYWHERE)
    before = stored.read()
    stored.replace(rows(spark, (1, "a", 2)), parts(), EVERYWHERE)
    assert [r.v for r in before.collect()] == [1] and values(stored) == [2]
    assert len(stored.vacuum()) == 1 and stored.vacuum() == [] and values(stored) == [2]


def test_any_order_of_writes_gives_what_a_dictionary_gives(spark, tmp_path):
    rng = random.Random(4)
    stored, want = table(spark, tmp_path), {}
    for step in range(14):
        company = rng.choice([None, None, "", "a", "b/c=d"])
        first, last = sorted(rng.choices(range(1, 8), k=2))
        region = rng.choice([days(first, last, company), days(first, last, company), Region(None, f"2024-01-{last:02}"), Region(second=encoded_value("a")), EVERYWHERE])
        span = range(first, last + 1) if region.low else range(1, last + 1) if region.high else [*range(1, 8), None]
        who = [c for c in ("", "a", "b/c=d", None) if region.second in (None, encoded_value(c))]
        told = [(d, c, 100 * step + i) for i, (d, c) in enumerate((d, c) for d in span for c in who) if rng.random() < 0.5]
        mode = "append" if step % 5 == 4 else "replace"
        stored.replace(rows(spark, *told), parts(), region, if_exists=mode)
        if mode == "replace":
            inside = lambda d: region.open or d is not None and region.has(f"2024-01-{d:02}")
            want = {v: (d, c) for v, (d, c) in want.items() if not (inside(d) and region.second in (None, encoded_value(c)))}
        want |= {v: (d, c) for d, c, v in told}
        got = {r.v: (r.day.day if r.day else None, r.company) for r in stored.read().collect()}
        assert got == want, (step, region)
        assert values(stored, days(2, 4)) == sorted(v for v, (d, _) in want.items() if d in (2, 3, 4))
        assert values(stored, days(2, 4, "a")) == sorted(v for v, (d, c) in want.items() if d in (2, 3, 4) and c == "a")


def test_modes(spark, tmp_path):
    stored = table(spark, tmp_path)
    stored.replace(rows(spark, (1, "a", 1)), parts(), days(1, 1), if_exists="fail")
    with pytest.raises(FileExistsError):
        stored.replace(rows(spark, (1, "a", 2)), parts(), days(1, 2), if_exists="fail")
    stored.replace(rows(spark, (2, "a", 2)), parts(), days(2, 2), if_exists="fail")
    stored.replace(rows(spark, (1, "a", 3)), parts(), days(1, 2), if_exists="append")
    assert values(stored) == [1, 2, 3]
    stored.replace(rows(spark), parts(), days(1, 2))
    assert values(stored) == [] and [w.mode for w in stored.history()] == ["fail", "fail", "append", "replace"]
    with pytest.raises(ValueError):
        stored.replace(rows(spark), parts(), EVERYWHERE, if_exists="upsert")


def test_writers_at_once_are_all_kept(spark, tmp_path):
    stored = table(spark, tmp_path)

    def one(i):
        company = f"c{i}"
        told = spark.range(0, 200, 1, 4).select(F.lit(date(2024, 1, 1)).alias("day"), F.lit(company).alias("company"), F.col("id").cast("int").alias("v"))
        return stored.replace(told, parts(), days(1, 1, company), run=company).rows

    with ThreadPoolExecutor(6) as pool:
        assert list(pool.map(inheritable_thread_target(spark)(one), range(6))) == [200] * 6
    assert {r.company: r["count"] for r in stored.read().groupBy("company").count().collect()} == {f"c{i}": 200 for i in range(6)}
    assert len(stored.history()) == 6


def test_a_number_is_given_to_one_commit(spark, tmp_path):
    stored = table(spark, tmp_path)
    assert stored._publish(1, {"writes": [], "done": None})
    assert not stored._publish(1, {"writes": [], "done": None})


def test_columns_that_one_month_has_stay(spark, tmp_path):
    for order in ((0, 1), (1, 0)):
        stored = table(spark, tmp_path / str(order[0]), None)
        months = [rows(spark, (1, "a", 1)), rows(spark, (2, "a", 2)).withColumn("extra", F.lit("e"))]
        for i in order:
            stored.replace(months[i], parts(), days(i + 1, i + 1))
        got = sorted((r.v, r.extra) for r in stored.read().collect())
        assert got == [(1, None), (2, "e")]
        assert sorted((r.v, r.extra) for r in stored.read(days(1, 1)).collect()) == [(1, None)]
    with pytest.raises(ValueError, match="column v is int and string"):
        merged([StructType.fromDDL("v int"), StructType.fromDDL("w int, v string")])


def test_one_day_of_many_partitions_lists_that_day_only(spark, tmp_path):
    stored = table(spark, tmp_path)
    many = spark.range(10_000).select(
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 100).cast("int")).alias("day"), F.floor(F.col("id") / 100).cast("string").alias("company"), F.col("id").cast("int").alias("v")
    )
    assert stored.replace(many, parts(), EVERYWHERE).rows == 10_000
    found = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()

    def listed(region):
        before = found.getCount()
        count = stored.read(region).count()
        return count, found.getCount() - before

    day = (date(2024, 1, 1) + timedelta(days=41)).isoformat()
    assert listed(Region(day, day)) == (100, 100)
    assert listed(Region(day, day, encoded_value("7"))) == (1, 1)
    assert listed(Region("2025-01-01", "2025-01-31")) == (0, 0)


@pytest.fixture(scope="module")
def sources(spark):
    return sample.sources(spark, SF_SMALL)


def test_a_run_that_died_is_told_and_taken_up(spark, sources, tmp_path):
    scope = Scope("co-1", "2024-01-03", "2024-01-20")
    dead = run.Run(spark, str(tmp_path / "died"), scope, "2024-1-01")
    with pytest.raises(Exception):  # a duration that is no number stops the aggregates
        dead.all(sources)
    told = {r.table_name: r for r in run.ledger(spark, dead.root).collect()}
    assert {n for n, r in told.items() if r.written} >= {"allocation_data", "tag_data", "msg_data", "ivr_data"}
    assert not any(r.finished for r in told.values()) and not told["channel_agg_overview"].written
    before = {t.name: len(t.at(spark, dead.root).history()) for t in run.WRITTEN}
    again = run.Run.resume(spark, dead.root, dead.run_id)
    assert (again.scope, again.allocation_month) == (scope, "2024-1-01")
    loaded = again.all(sources, "null")
    whole = run.Run(spark, str(tmp_path / "whole"), scope, "2024-1-01")
    assert loaded == whole.all(sources, "null")
    assert {t.name: rows_of(again.read(t)) for t in run.TABLES} == {t.name: rows_of(whole.read(t)) for t in run.TABLES}
    after = {t.name: len(t.at(spark, dead.root).history()) for t in run.WRITTEN}
    assert all(after[n] == 1 for n in after) and before["msg_data"] == 1
    told = {r.table_name: r for r in run.ledger(spark, dead.root).collect()}
    assert all(r.finished and r.written and r.run_id == dead.run_id for r in told.values())
    assert told["msg_data"].table_rows == sum(told["msg_data"].by_channel.values()) == loaded["msg_data"].rows
    with pytest.raises(ValueError, match="no run"):
        run.Run.resume(spark, dead.root, "other")


def test_two_companies_at_once(spark, sources, tmp_path):
    def one(place, company):
        job = run.Run(spark, str(tmp_path / place), Scope(company, "2024-01-03", "2024-01-12"), "2024-1-01")
        return job, job.all(sources, "null")

    for company in ("co-0", "co-1"):
        apart, _ = one("apart", company)
    with ThreadPoolExecutor(2) as pool:
        both = list(pool.map(inheritable_thread_target(spark)(lambda c: one("together", c)), ("co-0", "co-1")))
    together = both[0][0]
    same = [run.MSG_DATA, run.IVR_DATA, run.ALLOCATION_DATA, run.TAG_DATA, run.MSG_AGG_DATA]
    for t in same:
        assert rows_of(together.read(t)) == rows_of(apart.read(t)), t.name


def test_a_run_that_appends_or_refuses(spark, sources, tmp_path):
    scope = Scope("co-1", "2024-01-03", "2024-01-05")
    first = run.Run(spark, str(tmp_path), scope, "2024-1-01", if_exists="fail")
    first.extract(sources)
    with pytest.raises(FileExistsError):
        run.Run(spark, str(tmp_path), scope, "2024-1-01", if_exists="fail").extract(sources)
    once = rows_of(first.read(run.MSG_DATA))
    run.Run(spark, str(tmp_path), scope, "2024-1-01", if_exists="append").extract(sources)
    assert rows_of(first.read(run.MSG_DATA)) == sorted([*once, *once], key=repr)


def test_source_columns_of_one_month_come_back(spark, sources, tmp_path):
    """A later month's default table has one more column than an earlier one's."""
    months = [r[0] for r in sources.lending_default_details.select("allocation_month").distinct().orderBy("allocation_month").limit(2).collect()]
    assert len(months) == 2
    more = run.Sources(**{**vars(sources), "lending_default_details": sources.lending_default_details.withColumn("bucket", F.lit("x"))})
    for month, of in zip(months, (sources, more), strict=True):
        job = run.Run(spark, str(tmp_path), Scope(None, "2024-01-03", "2024-01-04"), month)
        job.extract(of)
    got = job.read(run.ALLOCATION_DATA).groupBy("allocation_month").agg(F.count(F.lit(1)).alias("n"), F.count("bucket").alias("k")).collect()
    assert {r.allocation_month: r.k for r in got} == {months[0]: 0, months[1]: next(r.n for r in got if r.allocation_month == months[1])}
