"""Python workers stay with an executor, each with what it grew to: a task needs one of them at a time."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from corpus_rows import SF_SMALL, documents, texts

import corpus_pipeline
from duepulse.llm import components, mixing, tables

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def steps_of_a_task(plan):
    """The most Python steps that one task of the plan runs, one within another."""
    most, path = 0, []
    for line in plan.splitlines():
        name = line.lstrip(" :+-*")
        path = [(depth, n) for depth, n in path if depth < len(line) - len(name)]
        path.append((len(line) - len(name), name))
        behind = [n for _, n in path]
        exchanges = [i for i, n in enumerate(behind) if "Exchange" in n.split()[0]] if name else []
        own = behind[exchanges[-1] + 1 if exchanges else 0 :]
        most = max(most, sum("InArrow" in n.split()[0] for n in own if n))
    return most


@pytest.fixture
def plans(monkeypatch):
    """Plans of the tables that are written meanwhile."""
    seen, stored = [], tables.stored

    def noted(df, folder=None):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, folder)

    monkeypatch.setattr(tables, "stored", noted)
    return seen


def test_a_task_of_the_join_runs_one_python_step(spark, plans):
    words = [f"w{k}" for k in range(80)]
    rows = texts(spark, (3, " ".join(words)), (4, " ".join(words[:-1])), (5, " ".join(words)), (6, "alone"), (7, None))
    kept = corpus_pipeline.drop_near_copies(spark, rows, SF_SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6, 7]
    assert [steps_of_a_task(p) for p in plans if "InArrow" in p] == [1, 1, 1]


def test_steps_are_counted(spark):
    twice = spark.range(3).mapInArrow(lambda b: b, "id long").mapInArrow(lambda b: b, "id long")
    count = lambda df: steps_of_a_task(df._jdf.queryExecution().executedPlan().toString())
    assert count(twice) == 2
    assert count(twice.repartition("id").mapInArrow(lambda b: b, "id long")) == 2
    assert count(spark.range(3).mapInArrow(lambda b: b, "id long").repartition("id").mapInArrow(lambda b: b, "id long")) == 1


def test_contracted_edges_give_the_same_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 7), (200, 300), (300, 200), (400, 401), (400, 401)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    want = {(r.node, r.component) for r in components.components(df).collect()}
    assert {(r.node, r.component) for r in components.components(df, contracted=True).collect()} == want
    stars = df.mapInArrow(components.contracting(lambda batches: batches), "a long, b long")
    assert {(r.node, r.component) for r in components.components(stars, contracted=True).collect()} == want


def test_sources_come_to_the_plan_without_python(spark, plans):
    rows = documents(spark, [(1, "a b c", "en", "x"), (2, "d e", "en", None), (3, None, "en", "y")], clashing=False)
    found = tables.stored(mixing.mix_sources(tables.stored(rows)))
    assert {r.source: (r.source_size, r.target) for r in found.collect()} == {"x": (3, 6.0), None: (2, 1.5), "y": (0, 0.0)}
    assert "InArrow" in "".join(plans) and max(map(steps_of_a_task, plans)) == 1
    plan = mixing.mixed_documents(tables.stored(rows))._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "LocalTableScan" in plan


def test_a_worker_gives_freed_memory_back():
    """Small pieces below one that stays: without a release they remain the process's."""
    code = """
import re, pyarrow as pa
from duepulse.llm import tables

def held():
    return int(re.search(r"Pss_Anon: +([0-9]+)", open("/proc/self/smaps_rollup").read())[1]) >> 10

batch = pa.RecordBatch.from_arrays([pa.array(range(3))], names=["a"])
def batches():
    yield batch
    global last, high
    kept = [bytearray(4000) for _ in range(20000)]
    last, high = bytearray(5000), held()
    del kept

for columns in tables.slices(batches()):
    pass
print(high - held())
"""
    env = {**os.environ, "ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, check=True, timeout=60)
    assert int(done.stdout) > 50
