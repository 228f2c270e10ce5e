"""Loads into a database and reads by ranges: their SQL, run in this process by DuckDB."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import DataFrameWriter, functions as F

from duepulse.sources import readers
from duepulse.sources.loads import LOAD, ROW, Load, literal, load_database, quoted, staged
from duepulse.sources.readers import key_ranges, key_slices, quantile_query, read_database_by_key, read_parquet
from duepulse.sources.writers import write_clustered


@pytest.fixture()
def database():
    connection = duckdb.connect()
    connection.execute("CREATE TABLE facts (company VARCHAR, v INT)")
    connection.execute(f"CREATE TABLE facts_staging (company VARCHAR, v INT, {LOAD} VARCHAR, {ROW} BIGINT)")
    return connection


def run(connection, statements):
    connection.execute("BEGIN")
    try:
        for statement in statements:
            connection.execute(statement)
    except Exception:
        connection.execute("ROLLBACK")
        raise
    connection.execute("COMMIT")


def stage(connection, load, rows):
    for number, (company, v) in rows:
        connection.execute("INSERT INTO facts_staging VALUES (?, ?, ?, ?)", [company, v, load.load_id, number])


def facts(connection):
    return sorted(connection.execute("SELECT company, v FROM facts").fetchall(), key=repr)


ROWS = list(enumerate([("a", 1), ("a", 1), ("b", 2), (None, None)]))


def test_a_task_that_runs_twice_and_a_load_that_runs_twice_add_nothing(database):
    load = Load("facts", ("company", "v"), "day-1")
    run(database, load.preparation())
    stage(database, load, ROWS)
    stage(database, load, ROWS[1:3])  # a task that ran again
    run(database, load.transaction())
    want = sorted([r for _, r in ROWS], key=repr)  # equal rows of the source stay two
    assert facts(database) == want
    run(database, load.transaction())
    run(database, load.preparation())
    stage(database, load, ROWS)  # the whole load again
    run(database, load.transaction())
    assert facts(database) == want
    assert database.execute("SELECT count(*) FROM facts_staging").fetchone() == (0,)
    assert database.execute("SELECT * FROM facts_loads").fetchall() == [("day-1", 4)]


def test_what_a_dead_attempt_staged_is_cleared_and_other_loads_are_not(database):
    dead, other = Load("facts", ("company", "v"), "day-1"), Load("facts", ("company", "v"), "o'clock")
    run(database, dead.preparation())
    stage(database, dead, [(9, ("gone", 9))])
    stage(database, other, [(0, ("kept", 5))])
    run(database, dead.preparation())
    stage(database, dead, ROWS[:1])
    run(database, dead.transaction())
    run(database, other.transaction())
    assert facts(database) == [("a", 1), ("kept", 5)]


def test_replaced_in_the_same_transaction_and_once(database):
    database.execute("INSERT INTO facts VALUES ('a', 7), ('b', 8)")
    load = Load("facts", ("v", "company"), "x", "replace", "company = 'a'")
    run(database, load.preparation())
    stage(database, load, ROWS[:2])
    with pytest.raises(Exception, match="lost"):
        run(database, [*load.transaction()[:2], "SELECT error('lost')"])
    assert facts(database) == [("a", 7), ("b", 8)]
    run(database, load.transaction())
    assert facts(database) == [("a", 1), ("a", 1), ("b", 8)]
    run(database, load.transaction())  # what it loaded isn't taken for what it replaces
    assert facts(database) == [("a", 1), ("a", 1), ("b", 8)]


def test_refused_where_rows_are(database):
    load = Load("facts", ("company", "v"), "x", "fail", "company = 'a'")
    run(database, load.preparation())
    database.execute("INSERT INTO facts VALUES ('b', 8)")
    stage(database, load, ROWS[:1])
    run(database, load.transaction())
    again = Load("facts", ("company", "v"), "y", "fail", "company = 'a'")
    stage(database, again, ROWS[:1])
    with pytest.raises(duckdb.ConstraintException, match="NOT NULL"):
        run(database, again.transaction())
    assert facts(database) == [("a", 1), ("b", 8)]


def test_names_are_quoted_and_columns_are_the_targets_own():
    assert quoted('s.t"x') == '"s"."t""x"' and literal("o'c") == "'o''c'"
    with pytest.raises(ValueError, match="staging"):
        Load("t", ("a", ROW), "x")
    with pytest.raises(ValueError):
        Load("t", ("a",), "x", "upsert")


def test_the_steps_of_a_load(spark, monkeypatch, tmp_path):
    seen = []

    def jdbc(writer, url, table, mode=None, properties=None):
        seen.append((table, mode, [r[ROW] for r in writer._df.collect()], writer._df.rdd.getNumPartitions()))

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    spark.range(40).selectExpr("string(id) AS company", "int(id) AS v", "1 AS more").repartition(4).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    load = Load("facts", ("company", "v"), "x")
    done = load_database(rows, "jdbc:x", {}, load, execute=seen.append, connections=2)
    assert done.rows == 40
    assert [s if isinstance(s, list) else s[:2] for s in seen] == [("facts_staging", "append"), load.preparation(), ("facts_staging", "append"), load.transaction()]
    numbers = seen[2][2]
    assert len(set(numbers)) == 40 and seen[2][3] <= 2
    assert sorted(numbers) == sorted(r[ROW] for r in staged(rows, load).collect())  # the same in every attempt


def test_ranges_cover_each_row_once_and_evenly_on_a_skewed_key():
    rng = random.Random(2)
    keys = [int(1.01 ** rng.randrange(2000)) for _ in range(20_000)] + [5] * 10_000 + [None] * 50 + [-(2**63)]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t AS SELECT unnest(?::BIGINT[]) AS k", [keys])
    bounds = [r[0] for r in connection.execute(f"SELECT k FROM {quantile_query('t', 'k', 16)}").fetchall()]
    ranges = key_ranges("k", bounds)
    counts = [connection.execute(f"SELECT count(*) FROM t WHERE {r}").fetchone()[0] for r in ranges]
    assert sum(counts) == len(keys) and counts[-1] == 50
    share = len(keys) / 16
    hot = sum(k == 5 for k in keys)
    assert all(c < hot + 2 * share for c in counts) and sum(c > 1.6 * share for c in counts) == 1
    modulo = [connection.execute(f"SELECT count(*) FROM t WHERE {r}").fetchone()[0] for r in key_slices("k", 4)]
    assert sum(modulo) == len(keys)  # the smallest long included


def test_ranges_of_texts_few_keys_and_none():
    assert key_ranges("k", ["b", "a'c", "a'c", "d"]) == ["k <= 'a''c'", "k > 'a''c' AND k <= 'b'", "k > 'b'", "k IS NULL"]
    assert key_ranges("k", [3]) == key_ranges("k", []) == ["k IS NOT NULL", "k IS NULL"]


def test_reader_asks_for_bounds_then_for_ranges(spark, monkeypatch):
    asked = []

    def read(spark_, url, table, properties, slices=None, fetch_rows=0):
        asked.append((table, slices))
        return spark.createDataFrame([(10,), (20,), (30,)], "k int")

    monkeypatch.setattr(readers, "read_database", read)
    read_database_by_key(spark, "jdbc:x", "tags", {}, "loan_id", 3)
    assert asked == [(quantile_query("tags", "loan_id", 3), None), ("tags", ["loan_id <= 10", "loan_id > 10 AND loan_id <= 20", "loan_id > 20", "loan_id IS NULL"])]


def scanned(df):
    """Rows that the scan gave, by its own metric."""
    df._jdf.queryExecution().toRdd().count()
    plan = df._jdf.queryExecution().executedPlan()
    nodes, found = [plan], 0
    while nodes:
        node = nodes.pop()
        if "Scan" in node.nodeName():
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
    return found


def test_clustered_files_are_skipped(spark, tmp_path):
    rows = spark.range(0, 60_000, 1, 8).selectExpr("concat('co-', lpad(int(id * 7919 % 500), 4, '0')) AS company_id", "id AS v")
    plain, near = str(tmp_path / "plain"), str(tmp_path / "near")
    rows.write.parquet(plain)
    assert write_clustered(rows, near, ["company_id", "v"], files=16).rows == 60_000
    one = F.col("company_id") == "co-0123"
    want = sorted(r.v for r in read_parquet(spark, plain).where(one).collect())
    assert sorted(r.v for r in read_parquet(spark, near).where(one).collect()) == want and len(want) == 120
    assert scanned(read_parquet(spark, plain).where(one)) == 60_000
    assert scanned(read_parquet(spark, near).where(one)) <= 2 * 60_000 // 16 + 2_000
    # Not there, though every file's range has it: the filter tells.
    mixed = str(tmp_path / "mixed")
    spark.range(0, 20_000, 1, 2).selectExpr("concat('co-', lpad(int(id % 500 * 2), 4, '0')) AS company_id", "id AS v").write.option("parquet.bloom.filter.enabled#company_id", "true").option("parquet.enable.dictionary", "false").parquet(mixed)
    assert scanned(read_parquet(spark, mixed).where("company_id = 'co-0123'")) == 0
