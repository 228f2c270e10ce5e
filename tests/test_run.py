from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import makers
from told import SF_SMALL, at, rows_of
from duepulse.operators.extract import extract_messages
from duepulse.operators.scope import EVERYTHING, Scope
from duepulse.plans import reports, run
from duepulse.sources import sample

MONTH = "2024-1-01"


@pytest.fixture(scope="module")
def sources(spark):
    return sample.sources(spark, SF_SMALL)


def contents(job):
    return {t.name: rows_of(job.read(t)) for t in run.TABLES}


def start(spark, root, company="co-1", first="2024-01-03", last="2024-01-20"):
    return run.Run(spark, str(root), Scope(company, first, last), MONTH)


def test_running_twice_changes_nothing(spark, sources, tmp_path):
    job = start(spark, tmp_path)
    loaded = job.all(sources, "null")
    once = contents(job)
    # The overview is stored by the day of creation and read rolled up.
    overview = loaded.pop("channel_agg_overview")
    assert overview.rows >= len(once["channel_agg_overview"]) > 0
    assert {n: r.rows for n, r in loaded.items()} == {n: len(once[n]) for n in loaded}
    assert all(r.any_rows for r in loaded.values())
    job.all(sources, "null")
    assert contents(job) == once


def test_companies_one_by_one_equal_one_run_for_all(spark, sources, tmp_path):
    for company in ("co-0", "co-1", "co-2"):
        apart = start(spark, tmp_path / "apart", company)
        apart.all(sources, "null")
    together = start(spark, tmp_path / "together", None)
    together.all(sources, "null")
    assert contents(apart) == contents(together)


def test_tables_equal_the_reports_on_the_sources(spark, sources, tmp_path):
    job = start(spark, tmp_path)
    job.all(sources, "null")
    scope = job.scope
    messages = extract_messages(sources.communication, scope)
    assert rows_of(job.read(run.MSG_DATA)) == rows_of(messages)
    tags = job.read(run.TAG_DATA)
    msg, ivr = job.read(run.MSG_AGG_DATA), job.read(run.IVR_AGG_DATA)
    want = reports.datewise_response(msg, ivr, tags, sources.click_data, scope)
    assert rows_of(job.read(run.DATEWISE_CHANNEL_RESPONSE)) == rows_of(want)


def test_corrected_sources_replace_and_empty_days_disappear(spark, sources, tmp_path):
    job = start(spark, tmp_path / "corrected")
    job.all(sources, "null")
    gone = F.to_date("created") == "2024-01-10"
    less = run.Sources(**{**vars(sources), "communication": sources.communication.where(~gone)})
    job.all(less, "null")
    fresh = start(spark, tmp_path / "fresh")
    fresh.all(less, "null")
    assert contents(job) == contents(fresh)


def test_neighbouring_runs_keep_each_others_days(spark, sources, tmp_path):
    parts = [("2024-01-03", "2024-01-10"), ("2024-01-11", "2024-01-20")]
    for first, last in parts:
        job = start(spark, tmp_path / "parts", "co-1", first, last)
        job.all(sources, "null")
    whole = start(spark, tmp_path / "whole")
    whole.all(sources, "null")
    got, want = contents(job), contents(whole)
    assert contents(job) == contents(whole)


def test_overlapping_runs_count_nothing_twice(spark, sources, tmp_path):
    for last in ("2024-01-20", "2024-01-21"):
        job = start(spark, tmp_path / "grown", "co-1", "2024-01-03", last)
        job.all(sources, "null")
    whole = start(spark, tmp_path / "whole", "co-1", "2024-01-03", "2024-01-21")
    whole.all(sources, "null")
    got = contents(job)
    assert got == contents(whole)
    overview = job.read(run.CHANNEL_AGG_OVERVIEW)
    direct = reports.channel_overview(
        job.read(run.MSG_AGG_DATA), job.read(run.IVR_AGG_DATA), job.read(run.TAG_DATA), job.scope
    )
    assert rows_of(overview) == rows_of(direct)


def test_a_month_without_a_name_keeps_its_population(spark, sources, tmp_path):
    tags = makers.tags(
        spark, [{"company_id": "co-1", "loan_id": f"L{i}", "tag_name": "t", "allocation_month": m} for i in range(40) for m in ("", "2024-1-01")]
    )
    job = run.Run(spark, str(tmp_path), EVERYTHING)
    for _ in range(2):
        job.all(run.Sources(**{**vars(sources), "tags": tags}), "null")
    assert rows_of(job.read(run.TAG_DATA)) == rows_of(tags.select(*run.TAG_DATA.schema.names))
    blank = job.read(run.CHANNEL_CONNECTIVITY_RESPONSE).where("allocation_month = ''")
    assert {r.max_triggered for r in blank.collect()} == {40}


def test_calls_of_a_company_loaded_earlier_are_aggregated_again(spark, tmp_path):
    def one(company):
        calls = makers.communication(
            spark,
            [{"company_id": company, "type_of_comm": "dtmf_ivr", "created": at("2024-01-05 09:00:00"),
              "payload": {"start_time": "2024-01-05 10:00:00", "call_duration": "5"}}],
        )
        nothing = spark.createDataFrame(
            [], "company_id string, loan_id string, allocation_month string, additional_variables string, "
            "amount_recovered_breakdown string, loan_details string"
        )
        defaults, details = nothing.drop("loan_details"), nothing.select("company_id", "loan_id", "loan_details")
        return run.Sources(calls, defaults, details, makers.tags(spark, []), makers.clicks(spark, []))

    for company in ("c", "d"):
        job = start(spark, tmp_path, company, "2024-01-05", "2024-01-05")
        loaded = job.all(one(company))
    assert loaded["ivr_agg_data"].rows == 2
    assert loaded["tag_data"].any_rows is False
    assert sorted(r.company_id for r in job.read(run.IVR_AGG_DATA).collect()) == ["c", "d"]
    assert sorted(r.company_id for r in job.read(run.HOURWISE_CHANNEL_RESPONSE).collect()) == ["c", "d"]


def test_every_day_and_company(spark, sources, tmp_path):
    job = run.Run(spark, str(tmp_path), EVERYTHING)
    loaded = job.all(sources, "null")
    messages = extract_messages(sources.communication)
    assert loaded["msg_data"].rows == messages.count()
    by_channel = {r[0]: r[1] for r in messages.groupBy(F.lower("type_of_comm")).count().collect()}
    assert loaded["msg_data"].by_name == by_channel
