"""What the JDBC reader and writer ask of Spark. No database is involved."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql.types import StructType

from duepulse.session import REQUIRED_CONF, cluster_conf
from duepulse.sources.readers import conformed, key_slices, read_database, time_slices
from duepulse.sources.writers import write_database


class Recorder:
    def __init__(self):
        self.calls = []

    def jdbc(self, *args, **kwargs):
        self.calls.append((args, kwargs))


def test_reader_gives_each_slice_its_own_task():
    reader = Recorder()
    slices = time_slices("created", "2024-01-01", "2024-01-02", 2)
    read_database(SimpleNamespace(read=reader), "jdbc:x", "communication", {"user": "u"}, slices)
    ((args, kwargs),) = reader.calls
    assert args == ("jdbc:x", "communication")
    assert kwargs == {"predicates": slices, "properties": {"preferTimestampNTZ": "true", "user": "u", "fetchsize": "50000"}}


def test_reader_without_slices():
    reader = Recorder()
    read_database(SimpleNamespace(read=reader), "jdbc:x", "tags", {}, fetch_rows=10)
    assert reader.calls == [(("jdbc:x", "tags"), {"properties": {"preferTimestampNTZ": "true", "fetchsize": "10"}})]


def test_writer_sets_mode_batches_and_connections(spark, monkeypatch):
    seen = {}

    def jdbc(writer, url, table, mode=None, properties=None):
        rows = writer._df
        seen.update(url=url, table=table, mode=mode, properties=properties, tasks=rows.rdd.getNumPartitions())
        rows.write.format("noop").mode("overwrite").save()

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    done = write_database(spark.range(100), "jdbc:x", "msg_data", {"user": "u"}, "replace", connections=3)
    assert done.rows == 100
    assert seen == {
        "url": "jdbc:x",
        "table": "msg_data",
        "mode": "overwrite",
        "properties": {"user": "u", "batchsize": "20000"},
        "tasks": 3,
    }


def test_cluster_conf_follows_input_and_cores():
    terabyte = 1024**4
    large, small = cluster_conf(100 * terabyte, 4000), cluster_conf(1, 4000)
    partitions = int(large["spark.sql.shuffle.partitions"])
    scans = 100 * terabyte / int(large["spark.sql.files.maxPartitionBytes"])
    block = 25 * terabyte / scans / partitions
    assert 200 * 1024 <= block <= 1024 * 1024
    assert 25 * terabyte / partitions <= 2 * 1024**3
    assert scans >= 2 * 4000
    assert small["spark.sql.shuffle.partitions"] == "8000"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * 1024**2)
    assert REQUIRED_CONF.items() <= large.items()


def test_key_slices_cover_each_row_once(spark):
    rows = spark.range(-50, 50).selectExpr("if(id % 7 = 0, NULL, id) AS k")
    counts = [rows.where(c).count() for c in key_slices("k", 4)]
    assert sum(counts) == 100 and all(counts)


def test_declared_types_are_enforced(spark):
    schema = StructType().add("a", "long").add("t", "timestamp_ntz")
    rows = spark.sql("SELECT 1 AS a, timestamp_ntz'2024-01-05 10:00:00' AS t, 'x' AS more")
    got = conformed(rows, schema)
    assert [f.dataType for f in got.schema.fields[:2]] == [f.dataType for f in schema.fields]
    assert got.columns == ["a", "t", "more"]
    with pytest.raises(ValueError, match="columns missing: t"):
        conformed(rows.drop("t"), schema)
