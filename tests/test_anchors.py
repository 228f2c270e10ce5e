"""Row counts and sums written down in FIXTURES.md, section 3, for its own source tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import anchor_sources
from told import SF
from duepulse.operators.aggregate import aggregate_ivr, aggregate_messages
from duepulse.operators.extract import (
    extract_allocation,
    extract_ivr,
    extract_messages,
    extract_tags,
)
from duepulse.operators.scope import Scope
from duepulse.plans import reports

RUN = Scope("co-1", "2024-01-03", "2024-01-20")
DAYS = Scope(None, "2024-01-03", "2024-01-20")
MONTH = "2024-1-01"


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("anchors")
    stored = {}
    for name, df in anchor_sources.tables(spark, SF).items():
        df.write.parquet(f"{folder}/{name}")
        stored[name] = spark.read.parquet(f"{folder}/{name}")
    return stored


@pytest.fixture(scope="module")
def aggregates(source, tmp_path_factory, spark):
    folder = tmp_path_factory.mktemp("aggregates")
    facts = source["communication"]
    tables = {
        "msg": aggregate_messages(extract_messages(facts, RUN), RUN),
        "ivr": aggregate_ivr(extract_ivr(facts), DAYS),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
        tables[name] = spark.read.parquet(f"{folder}/{name}")
    return tables


def test_source_tables(source):
    want = {
        "communication": 10_435,
        "tags": 185,
        "click_data": 404,
        "lending_default_details": 15_000,
        "lending_loan_details": 1_312,
    }
    assert {n: df.count() for n, df in source.items()} == want


def test_facts(source):
    facts = source["communication"]
    assert extract_messages(facts, RUN, ["whatsapp"]).count() == 794
    assert extract_messages(facts, RUN, ["sms"]).count() == 404
    assert extract_messages(facts).count() == 6_256
    assert extract_ivr(facts, RUN).count() == 735
    assert extract_ivr(facts).count() == 3_706
    defaults, details = source["lending_default_details"], source["lending_loan_details"]
    assert extract_allocation(defaults, details, RUN, MONTH).count() == 3_342
    assert extract_tags(source["tags"], RUN, MONTH).count() == 54


def test_languages(source):
    got = extract_messages(source["communication"]).groupBy("comm_language").count().collect()
    want = {"ta": 609, "kn": 632, "be": 616, "te": 647, "en": 2262, "hi": 929, None: 561}
    assert {r.comm_language: r["count"] for r in got} == want


def test_loan_aggregates(source, aggregates):
    facts = source["communication"]
    per_channel = aggregates["msg"].groupBy("type_of_comm").count().collect()
    assert {r.type_of_comm: r["count"] for r in per_channel} == {"whatsapp": 685, "sms": 378}
    assert aggregates["ivr"].count() == 1_951
    assert aggregate_ivr(extract_ivr(facts, RUN), DAYS).count() == 641

    every = aggregate_messages(extract_messages(facts)).groupBy("type_of_comm")
    got = {
        r.type_of_comm: (r.n, r.sent, r.most)
        for r in every.agg(
            F.count("*").alias("n"), F.sum("trigger_count").alias("sent"), F.max("trigger_count").alias("most")
        ).collect()
    }
    assert {k: v[:2] for k, v in got.items()} == {"whatsapp": (3_604, 4_201), "sms": (1_878, 2_055)}
    assert max(v[2] for v in got.values()) == 4

    calls = aggregate_ivr(extract_ivr(facts))
    states = {r.ivr_resp_state: r["count"] for r in calls.groupBy("ivr_resp_state").count().collect()}
    assert states == {-1: 972, 0: 919, 1: 921, 2: 464}
    assert calls.agg(F.max("trigger_count")).first()[0] == 2


@pytest.mark.parametrize(
    ("report", "message_rows", "call_rows"),
    [
        (reports.channel_overview, 249, 126),
        (reports.channel_connectivity, 285, 144),
        (reports.hourwise_response, 841, 760),
    ],
)
def test_report_rows(source, aggregates, report, message_rows, call_rows):
    found = report(aggregates["msg"], aggregates["ivr"], source["tags"], scope=RUN)
    calls = found.where("type_of_comm = 'dtmf_ivr'").count()
    assert (found.count() - calls, calls) == (message_rows, call_rows)


def test_datewise_multiplies_by_clicks(source, aggregates):
    msg, ivr, tags, clicks = aggregates["msg"], aggregates["ivr"], source["tags"], source["click_data"]
    sums = F.sum("loan_id_count"), F.sum("trigger_count_sum")
    found = reports.datewise_response(msg, None, tags, clicks, RUN)
    assert found.count() == 285
    assert tuple(found.agg(*sums).first()) == (1_433, 2_076)
    without = reports.datewise_response(msg, None, tags, clicks.limit(0), RUN)
    assert tuple(without.agg(*sums).first()) == (1_143, 1_658)
    assert reports.datewise_response(None, ivr, tags, clicks, RUN).count() == 144
