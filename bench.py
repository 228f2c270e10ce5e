"""Times the headline queries and prints one JSON line.

The five source tables are written once, untimed, from the sample tables under
``$BENCH_SF_DIR``. Every query then starts from those tables: one warm-up, three timed
runs into the noop sink, median. ``full_run_one_run`` writes all ten tables for one company and 18
days, timed once over the tables of a first run.
``--duckdb`` adds the time of the same SQL in DuckDB on the same files.
"""

from __future__ import annotations

import json
import logging
import os
import statistics
import sys
import tempfile
import time

from duepulse.operators.aggregate import aggregate_ivr, aggregate_messages
from duepulse.operators.extract import (
    extract_allocation,
    extract_ivr,
    extract_messages,
    extract_tags,
)
from duepulse.operators.scope import Scope
from duepulse.plans import reports, run
from duepulse.session import build_session
from duepulse.sources import sample

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
TIMED_RUNS = 3


def session():
    logging.getLogger("SQLQueryContextLogger").setLevel(logging.CRITICAL)
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        # Building a plan is a third of a short query's time; this leaves out call sites.
        spark__python__sql__dataFrameDebugging__enabled="false",
        # The files here are small; on a cluster the setting follows the input size.
        spark__sql__adaptive__advisoryPartitionSizeInBytes="256k",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def staged_sources(spark, sf_dir: str, folder: str) -> run.Sources:
    tables = {}
    for name, df in vars(sample.sources(spark, sf_dir)).items():
        # Several files each, as a table of any size has them.
        df.repartition(int(CPUS)).write.mode("overwrite").parquet(f"{folder}/{name}")
        tables[name] = spark.read.parquet(f"{folder}/{name}")
    return run.Sources(**tables)


def headline(source: run.Sources):
    def messages():
        return aggregate_messages(extract_messages(source.communication))

    def calls():
        return aggregate_ivr(extract_ivr(source.communication), bad_durations="null")

    def report(name):
        return reports.from_communication(
            name, source.communication, source.tags, source.click_data, bad_durations="null"
        )

    return {
        "message_facts": lambda: extract_messages(source.communication),
        "ivr_facts": lambda: extract_ivr(source.communication),
        "allocation": lambda: extract_allocation(
            source.lending_default_details, source.lending_loan_details
        ),
        "loan_tags": lambda: extract_tags(source.tags),
        "message_loan_aggregate": messages,
        "ivr_loan_aggregate": calls,
        "channel_overview": lambda: report("channel_overview"),
        "channel_connectivity": lambda: report("channel_connectivity"),
        "datewise_response": lambda: report("datewise_response"),
        "hourwise_response": lambda: report("hourwise_response"),
    }


def seconds(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def median_seconds(action) -> float:
    action()
    return round(statistics.median(seconds(action) for _ in range(TIMED_RUNS)), 3)


def duckdb_seconds(folder: str) -> dict[str, float]:
    import duckdb

    import oracle_queries

    connection = duckdb.connect()
    connection.execute(f"SET threads = {CPUS}")
    for name in run.Sources.__dataclass_fields__:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}/*.parquet'")
    sql = oracle_queries.oracle_sql(sources_exist=True)
    return {
        name: median_seconds(lambda text=sql[name]: connection.execute(text).to_arrow_table())
        for name in headline(None)
    }


def main() -> None:
    spark = session()
    folder = tempfile.mkdtemp(prefix="duepulse-bench-")
    source = staged_sources(spark, SF_DIR, f"{folder}/sources")
    times = {}
    for name, query in headline(source).items():
        times[name] = median_seconds(
            lambda query=query: query().write.format("noop").mode("overwrite").save()
        )
    job = run.Run(spark, f"{folder}/tables", Scope("co-1", "2024-01-03", "2024-01-20"), "2024-1-01")
    job.all(source, "null")
    times["full_run_one_run"] = round(seconds(lambda: job.all(source, "null")), 3)
    result = {
        "metric": "communication analytics, sum of query medians",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
    }
    spark.stop()
    if "--duckdb" in sys.argv:
        result["duckdb"] = duckdb_seconds(f"{folder}/sources")
    print(json.dumps(result))


if __name__ == "__main__":
    main()
