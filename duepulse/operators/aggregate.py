"""Loan-level aggregates of messages and calls.

The groups are the loan and the full timestamp, so one busy loan or company
spreads over many reducers, and exact copies collapse before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from duepulse.functions import calls, messages
from duepulse.functions.measures import day_of
from duepulse.operators.scope import EVERYTHING, IVR_CHANNEL, MESSAGE_CHANNELS, Scope, of_channels
from duepulse.schemas import IVR_AGG_DATA, MSG_AGG_DATA


def aggregate_messages(
    msg_data: DataFrame, scope: Scope = EVERYTHING, channels: Sequence[str] = MESSAGE_CHANNELS
) -> DataFrame:
    """Flags and counts per loan, timestamp and channel, for all channels in one pass."""
    rows = of_channels(scope.of_company(msg_data), channels)
    rows = rows.where(scope.days(F.to_date("created")))
    return (
        rows.groupBy("loan_id", "created", "company_id", F.lower("type_of_comm").alias("channel"))
        .agg(
            F.max("comm_language").alias("comm_language"),
            F.sum(messages.present(F.col("delivery_status"))).alias("delivery_flag"),
            F.sum(messages.present(F.col("opened_status"))).alias("opened_flag"),
            F.count("type_of_comm").alias("trigger_count"),
            F.sum("click_count").alias("click_count"),
        )
        .withColumnRenamed("channel", "type_of_comm")
        .select(*MSG_AGG_DATA.names)
    )


_IVR_GROUP = (
    "loan_id",
    "created",
    "start_time",
    "company_id",
    "type_of_comm",
    "call_duration",
    "collectedMappedDtmfs",
    "collectedDtmfs",
    "error_nm",
)


def aggregate_ivr(
    ivr_data: DataFrame,
    scope: Scope = EVERYTHING,
    channel_label: str = IVR_CHANNEL,
    bad_durations: str = "fail",
) -> DataFrame:
    """Flags and counts per distinct call, by the day the call started.

    The groups are the raw values; flags are derived afterwards, so two groups
    may look alike. Only the days of ``scope`` apply: calls of every company
    in the input are aggregated, and their channel becomes ``channel_label``.
    """
    grouped = (
        ivr_data.where(scope.days(day_of(F.col("start_time"))))
        .groupBy(*_IVR_GROUP)
        .agg(F.count("type_of_comm").alias("trigger_count"))
    )
    seconds = calls.call_seconds(F.col("call_duration"), bad_durations)
    flagged = grouped.withColumns(
        {
            "call_pick": calls.call_picked(seconds),
            "call_resp": calls.call_responded(seconds),
            "end_of_message_rate": calls.end_of_message(F.col("collectedDtmfs")),
            "ivr_resp_state": calls.response_state(F.col("collectedMappedDtmfs")),
            "error_flag": calls.error_flag(F.col("error_nm")),
        }
    )
    return (
        flagged.withColumn("explicit_response", calls.state_label(F.col("ivr_resp_state")))
        .withColumn("type_of_comm", F.lit(channel_label))
        .select(*IVR_AGG_DATA.names)
    )


def aggregate_both(
    facts: DataFrame,
    scope: Scope = EVERYTHING,
    channel_label: str = IVR_CHANNEL,
    bad_durations: str = "fail",
) -> DataFrame:
    """Rows of ``extract_both`` per message group and distinct call, with one shuffle for both.

    Has the columns of either aggregate that the reports read; those of the other kind are NULL.
    A call's group counts as errored, picked up and so on once, as in ``aggregate_ivr``.
    """
    is_call = F.col("is_call")
    rows = facts.where(~is_call | scope.days(day_of(F.col("start_time"))))
    channel = F.when(is_call, F.col("type_of_comm")).otherwise(F.lower("type_of_comm"))
    grouped = rows.withColumn("type_of_comm", channel).groupBy("is_call", *_IVR_GROUP).agg(
        F.sum(messages.present(F.col("delivery_status"))).alias("delivery_flag"),
        F.sum(messages.present(F.col("opened_status"))).alias("opened_flag"),
        F.count("type_of_comm").alias("trigger_count"),
        F.sum("click_count").alias("click_count"),
    )
    # A message's call_duration is NULL, and so are its seconds.
    seconds = calls.call_seconds(F.col("call_duration"), bad_durations)
    return grouped.withColumns(
        {
            "call_pick": calls.call_picked(seconds),
            "call_resp": calls.call_responded(seconds),
            "end_of_message_rate": calls.end_of_message(F.col("collectedDtmfs")),
            "ivr_resp_state": calls.response_state(F.col("collectedMappedDtmfs")),
            "error_flag": calls.error_flag(F.col("error_nm")),
            "type_of_comm": F.when(is_call, F.lit(channel_label)).otherwise(F.col("type_of_comm")),
        }
    )


def rejected_durations(ivr_data: DataFrame, scope: Scope = EVERYTHING) -> DataFrame:
    """One row: how many calls have a duration that is not a whole number."""
    unreadable = F.col("call_duration").isNotNull() & F.col("call_duration").try_cast("int").isNull()
    rows = ivr_data.where(scope.days(day_of(F.col("start_time"))))
    return rows.agg(F.count(F.when(unreadable, 1)).alias("rejected_rows"))
