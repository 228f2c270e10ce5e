from __future__ import annotations

import pytest

import makers
from told import at, by
from duepulse import schemas
from duepulse.operators.aggregate import aggregate_ivr, aggregate_messages, rejected_durations
from duepulse.operators.scope import Scope


def test_messages_group_by_full_timestamp_and_channel(spark):
    nine, later = at("2024-01-05 09:00:00"), at("2024-01-05 09:00:01")
    rows = [
        {"type_of_comm": "whatsapp", "comm_language": "en", "delivery_status": "x", "click_count": None},
        {"type_of_comm": "WhatsApp", "comm_language": "ta", "opened_status": "y", "click_count": None},
        {"type_of_comm": "sms", "click_count": 2},
        {"type_of_comm": "SMS", "click_count": None},
        {"type_of_comm": "sms", "created": later, "loan_id": None},
        {"type_of_comm": "dtmf_ivr"},
        {"type_of_comm": None},
    ]
    df = makers.table(spark, schemas.MSG_DATA, rows, company_id="c", loan_id="L1", created=nine)
    found = aggregate_messages(df)
    assert found.schema.names == schemas.MSG_AGG_DATA.names
    got = by(found, "type_of_comm", "loan_id")
    assert set(got) == {("whatsapp", "L1"), ("sms", "L1"), ("sms", None)}
    wa = got["whatsapp", "L1"]
    assert (wa["comm_language"], wa["delivery_flag"], wa["opened_flag"], wa["trigger_count"]) == ("ta", 1, 1, 2)
    assert wa["click_count"] is None
    assert (got["sms", "L1"]["trigger_count"], got["sms", "L1"]["click_count"]) == (2, 2)
    assert aggregate_messages(df, Scope("c", "2024-01-05", "2024-01-05"), ["sms"]).count() == 2
    assert aggregate_messages(df, Scope("other")).isEmpty()


def test_calls_group_by_raw_values(spark):
    df = makers.ivr_facts(
        spark,
        [
            {"call_duration": "12"},
            {"call_duration": "12"},
            {"call_duration": "13"},
            {"call_duration": "12", "type_of_comm": "DTMF_IVR"},
            {"call_duration": None, "collectedDtmfs": "{}", "error_nm": "SYSTEM", "collectedMappedDtmfs": "{}"},
            {"start_time": None},
            {"company_id": "another"},
        ],
    )
    found = aggregate_ivr(df, Scope("c", "2024-01-05", "2024-01-05"))
    assert found.schema.names == schemas.IVR_AGG_DATA.names
    got = [r.asDict() for r in found.collect()]
    # The two durations look alike as flags but stay apart, as do the two spellings.
    picked = [r for r in got if r["company_id"] == "c" and r["call_resp"] == 1]
    assert sorted(r["trigger_count"] for r in picked) == [1, 1, 2]
    assert {r["type_of_comm"] for r in got} == {"dtmf_ivr"}
    (missed,) = [r for r in got if r["call_pick"] == 0]
    assert (missed["end_of_message_rate"], missed["ivr_resp_state"], missed["error_flag"]) == (0, -1, 1)
    assert missed["explicit_response"] == "EOM not reached"
    # The company of the scope does not apply to calls.
    assert len([r for r in got if r["company_id"] == "another"]) == 1
    assert len(got) == 5


def test_calls_are_picked_by_start_day(spark):
    df = makers.ivr_facts(
        spark,
        [{"created": at("2024-01-01 00:00:00")}, {"start_time": "2024-01-07 00:00:00"}],
    )
    got = aggregate_ivr(df, Scope(None, "2024-01-04", "2024-01-06")).collect()
    assert [r.created for r in got] == [at("2024-01-01 00:00:00")]


def test_bad_duration(spark):
    df = makers.ivr_facts(
        spark, [{"call_duration": v} for v in ("10.5", "", "7", None)] + [{"call_duration": "x", "start_time": None}]
    )
    with pytest.raises(Exception, match="not a whole number"):
        aggregate_ivr(df).collect()
    got = aggregate_ivr(df, bad_durations="null").collect()
    assert sorted(r.call_pick for r in got) == [0, 0, 0, 1]
    assert rejected_durations(df).first().rejected_rows == 2


def test_unreadable_start_time_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        aggregate_ivr(makers.ivr_facts(spark, [{"start_time": "yesterday"}])).collect()
