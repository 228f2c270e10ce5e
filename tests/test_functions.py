from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from duepulse.functions import calls, links, measures, messages


def apply(spark, expression, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    found = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in found]


def test_template_language(spark):
    names = ["due_Tamil", "KANNADA", "bengali", "x_teluguNEW", "telugu", "", None, "kannada tamil"]
    want = ["ta", "kn", "be", "te", "en", "en", None, "ta"]
    assert apply(spark, messages.template_language, names) == want


def test_message_language_needs_the_exact_channel_name(spark):
    def language(channel):
        return messages.message_language(channel, F.lit("hi"), F.lit("due_tamil"))

    channels = ["sms", "whatsapp", "SMS", "WhatsApp", "dtmf_ivr", None]
    assert apply(spark, language, channels) == ["hi", "ta", None, None, None, None]


def test_blank_and_presence(spark):
    assert apply(spark, messages.blank_to_null, ["", " ", "x", None]) == [None, " ", "x", None]
    assert apply(spark, messages.present, ["", "x", None]) == [1, 1, 0]


def test_call_flags(spark):
    def seconds(text):
        return calls.call_seconds(text)

    texts = ["-1", "0", "1", "9", "10", None]
    assert apply(spark, lambda x: calls.call_picked(seconds(x)), texts) == [0, 0, 1, 1, 1, 0]
    assert apply(spark, lambda x: calls.call_responded(seconds(x)), texts) == [0, 0, 0, 0, 1, 0]


@pytest.mark.parametrize("text", ["", "10.5", "ten"])
def test_bad_duration_fails_or_counts_as_missing(spark, text):
    with pytest.raises(Exception, match="not a whole number"):
        apply(spark, calls.call_seconds, [text])
    assert apply(spark, lambda x: calls.call_seconds(x, "null"), [text, "7"]) == [None, 7]


def test_bad_durations_option_is_checked():
    with pytest.raises(ValueError):
        calls.call_seconds(None, "skip")


def test_end_of_message(spark):
    assert apply(spark, calls.end_of_message, ["{}", '{"1":"1"}', "", None]) == [0, 1, 1, 1]


def test_response_state_and_label(spark):
    answers = ["{}", "0", '{"1":"Yes"}', '{"1":"NO"}', "no then yes", "I know", '{"1":"9"}', "00", None]
    assert apply(spark, calls.response_state, answers) == [-1, -1, 1, 2, 1, 2, 0, 0, 0]
    labels = ["EOM not reached", "Wrong input", "responded yes", "responded no", "Wrong input"]
    assert apply(spark, calls.state_label, [-1, 0, 1, 2, None], "int") == labels


def test_error_flag(spark):
    assert apply(spark, calls.error_flag, ["user_errors", "USER_Errors", "SYSTEM", "", None]) == [0, 0, 1, 1, 0]


def test_click_channel_underscore_is_one_character(spark):
    tags = ["xpreduewa", "xpredueZwa9", "a_predue_1_wa_b", "predue_sms", "PREDUE_sms", "postdue_wa", None]
    want = [None, "whatsapp", "whatsapp", "sms", None, None, None]
    assert apply(spark, links.click_channel, tags) == want
    assert apply(spark, links.click_channel, ["predue_sms_wa"]) == ["whatsapp"]


def test_share_rounds_half_away_from_zero(spark):
    pairs = [(1, 3), (2, 3), (1, 32), (-1, 32), (3, 20000), (5, 0), (None, 2), (1, None), (0, 7), (29, 160)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a bigint, b bigint")
    found = df.select("i", measures.share(F.col("a"), F.col("b")).alias("y")).orderBy("i").collect()
    want = [0.3333, 0.6667, 0.0313, -0.0313, 0.0002, None, None, None, 0.0, 0.1813]
    assert [r.y for r in found] == want


def test_time_buckets(spark):
    texts = ["2024-01-05 23:59:59", "2024-02-29 00:00:00"]
    assert [str(d) for d in apply(spark, measures.day_of, texts)] == ["2024-01-05", "2024-02-29"]
    assert apply(spark, measures.hour_of, texts) == [23, 0]
    assert apply(spark, measures.month_number, ["2022-8-01", "2024-12-01", None]) == [8, 12, None]
