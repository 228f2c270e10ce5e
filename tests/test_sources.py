from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from told import rows_of
from duepulse.sources.readers import read_catalog, read_parquet, read_staged, time_slices
from duepulse.sources.writers import (
    Covered,
    encoded,
    encoded_value,
    replace_covered,
    save_mode,
    write_catalog,
    write_parquet,
)


def test_time_slices_cover_each_moment_once():
    slices = time_slices("created", "2024-02-28", "2024-03-01", 2)
    assert len(slices) == 6
    assert slices[0] == "created >= '2024-02-28 00:00:00' AND created < '2024-02-28 12:00:00'"
    assert slices[-1] == "created >= '2024-03-01 12:00:00' AND created < '2024-03-02 00:00:00'"


def test_time_slices_as_filters(spark):
    df = spark.range(0, 4 * 86400, 600).selectExpr("timestamp_ntz'2024-02-27 12:00:00' + make_interval(0,0,0,0,0,0,id) AS created")
    counts = [df.where(s).count() for s in time_slices("created", "2024-02-28", "2024-03-01", 3)]
    assert sum(counts) == df.where("to_date(created) BETWEEN '2024-02-28' AND '2024-03-01'").count()


def test_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3)
    assert write_parquet(rows, path).rows == 3
    write_parquet(rows, path, "append")
    assert read_parquet(spark, path).count() == 6
    write_parquet(rows, path, "replace")
    assert read_parquet(spark, path).count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_parquet(rows, path, "fail")
    with pytest.raises(ValueError):
        save_mode("upsert")


def test_rows_are_counted_during_the_write(spark, tmp_path):
    nothing = write_parquet(spark.range(0), str(tmp_path / "none"))
    assert (nothing.rows, nothing.any_rows) == (0, False)
    some = write_parquet(spark.range(5).repartition(4), str(tmp_path / "some"))
    assert (some.rows, some.any_rows) == (5, True)


def test_catalog_binds_by_name(spark, tmp_path):
    spark.sql(f"CREATE TABLE by_name (a BIGINT, b BIGINT) USING parquet LOCATION '{tmp_path / 'by_name'}'")
    try:
        write_catalog(spark.range(1).selectExpr("id + 2 AS b", "id + 1 AS a"), "by_name")
        assert [tuple(r) for r in read_catalog(spark, "by_name").collect()] == [(1, 2)]
    finally:
        spark.sql("DROP TABLE by_name")


def months(spark, *rows):
    return spark.createDataFrame(list(rows), "company_id string, allocation_month string, v int")


def parts():
    return {"part_month": encoded(F.col("allocation_month")), "part_company": encoded(F.col("company_id"))}


def stored(spark, path, schema):
    whole = schema
    for name in ("part_month", "part_company"):
        whole = StructType([*whole.fields]).add(name, "string")
    return read_staged(spark, path, whole).select(*schema.names)


def test_texts_of_any_kind_come_back_as_they_were(spark, tmp_path):
    path = str(tmp_path / "t")
    df = months(
        spark, ("007", "2024-01-01", 1), ("a b=c/d:%e", "2024-1-01", 2), ("", "", 3), (None, None, 4), ("", None, 5), (None, "", 6)
    )
    for _ in range(2):
        assert replace_covered(df, path, parts(), Covered()).rows == 6
        assert rows_of(stored(spark, path, df.schema)) == rows_of(df)


def test_replace_leaves_other_partitions_and_empties_covered_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    strange = "a b=c/d:%e"
    first = months(
        spark,
        ("x", "m1", 1), ("x", "m2", 2), ("x", "m3", 3), ("y", "m1", 4), (strange, "m1", 5), (strange, "m2", 6), ("", "m1", 7),
    )
    assert replace_covered(first, path, parts(), Covered()).rows == 7
    two_months = [encoded_value("m1"), encoded_value("m2")]
    covered = Covered(lambda value: value in two_months, encoded_value("x"))
    done = replace_covered(months(spark, ("x", "m1", 10), ("x", "m1", 11)), path, parts(), covered)
    assert done.rows == 2
    left = sorted(r.v for r in stored(spark, path, first.schema).collect())
    assert left == [3, 4, 5, 6, 7, 10, 11]

    done = replace_covered(months(spark).limit(0), path, parts(), Covered(None, encoded_value(strange)))
    assert not done.any_rows
    assert sorted(r.v for r in stored(spark, path, first.schema).collect()) == [3, 4, 7, 10, 11]


def test_jobs_do_not_grow_with_the_partitions(spark, tmp_path):
    """Jobs and tasks' results of a write into 5 and into 500 partitions."""
    tracker = spark.sparkContext.statusTracker()
    jobs = {}
    for n in (5, 500):
        df = spark.range(n).selectExpr("concat('c', id) AS company_id", "concat('m', id % 5) AS allocation_month", "int(id) AS v")
        for again in (False, True):
            spark.sparkContext.setJobGroup(f"write-{n}-{again}", "a write")
            some = Covered(lambda value: value != "n", None)
            assert replace_covered(df, str(tmp_path / str(n)), parts(), some).rows == n
            jobs[n, again] = len(tracker.getJobIdsForGroup(f"write-{n}-{again}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(set(jobs.values())) == 1
    assert stored(spark, str(tmp_path / "500"), df.schema).count() == 500


def test_a_large_partition_is_cut_into_files(spark, tmp_path):
    path = str(tmp_path / "t")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    df = spark.range(0, 400_000, 1, 8).selectExpr(
        "if(id % 3 = 0, string(id % 5), 'hot') AS company_id", "'m' AS allocation_month", "rand(1) AS v"
    )
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
        assert replace_covered(df, path, parts(), Covered()).rows == 400_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = stored(spark, path, df.schema).select("company_id", F.input_file_name().alias("file"))
    counts = {r.company_id: r["count"] for r in files.distinct().groupBy("company_id").count().collect()}
    # A small partition whose key hashes to the place of the large one is cut along with it.
    small = sorted(n for k, n in counts.items() if k != "hot")
    assert counts["hot"] > 2
    assert small[0] == 1 and small[-1] < counts["hot"] + 1
