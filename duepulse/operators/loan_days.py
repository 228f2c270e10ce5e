"""Loan-day and loan-hour measures, in one shape for messages and calls.

Columns: company_id, loan_id, type_of_comm, date [, hours], then the measures
of ``MEASURES``. With one shape, the two branches of a report are united
before the joins, so tags are joined and rolled up once.

=========  ==========================  =====================================
measure    message                     call
=========  ==========================  =====================================
triggered  messages sent               calls made
delivered  messages delivered          calls made less errored groups
opened     messages opened             calls picked up
responded  0                           calls responded to
ended      0                           calls heard to the end
clicked    link clicks, may be NULL    0
explicit   link clicks, may be NULL    calls answered with yes
=========  ==========================  =====================================
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from duepulse.functions.calls import STATE_YES
from duepulse.functions.measures import day_of, hour_of
from duepulse.operators.scope import Scope

MEASURES = ("triggered", "delivered", "opened", "responded", "ended", "clicked", "explicit")
_COMBINE: dict[str, Callable[[Column], Column]] = {"max": F.max, "sum": F.sum}


def _by_loan(rows: DataFrame, by_hour: bool, measures: dict[str, Column], *more: str) -> DataFrame:
    keys = ["company_id", "loan_id", "type_of_comm", "date", *(["hours"] if by_hour else []), *more]
    return rows.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])


def message_loan_days(
    msg_agg: DataFrame, scope: Scope, combine: str = "sum", by_hour: bool = False
) -> DataFrame:
    """Message measures per loan and day (or hour): summed, or the day's largest."""
    pick = _COMBINE[combine]
    rows = scope.of_company(msg_agg).where(scope.days(F.to_date("created")))
    rows = rows.withColumns({"date": day_of(F.col("created")), "hours": hour_of(F.col("created"))})
    clicks = pick(F.col("click_count"))
    zero = F.lit(0).cast("bigint")
    return _by_loan(
        rows,
        by_hour,
        {
            "triggered": pick(F.col("trigger_count")),
            "delivered": pick(F.col("delivery_flag")),
            "opened": pick(F.col("opened_flag")),
            "responded": zero,
            "ended": zero,
            "clicked": clicks,
            "explicit": clicks,
        },
    )


def call_loan_days(
    ivr_agg: DataFrame, scope: Scope, combine: str = "sum", by_hour: bool = False
) -> DataFrame:
    """Call measures per loan and day (or hour). Errors are summed in either form, so the
    largest-of-day form may report fewer than no delivered calls."""
    pick = _COMBINE[combine]
    started = F.col("start_time")
    rows = scope.of_company(ivr_agg).where(started.isNotNull() & scope.days(day_of(started)))
    rows = rows.withColumns({"date": day_of(started), "hours": hour_of(started)})
    errors = F.sum("error_flag")
    return _by_loan(
        rows,
        by_hour,
        {
            "triggered": pick(F.col("trigger_count")),
            "delivered": pick(F.col("trigger_count")) - errors,
            "opened": pick(F.col("call_pick")).cast("bigint"),
            "responded": pick(F.col("call_resp")).cast("bigint"),
            "ended": pick(F.col("end_of_message_rate")).cast("bigint"),
            "clicked": F.lit(0).cast("bigint"),
            "explicit": pick((F.col("ivr_resp_state") == STATE_YES).cast("int")).cast("bigint"),
        },
    )


def message_overview_days(msg_agg: DataFrame, scope: Scope, by_created_day: bool = False) -> DataFrame:
    """Rows, triggered and delivered messages per loan and day."""
    rows = scope.of_company(msg_agg).where(scope.days(F.to_date("created")))
    return _overview(rows.withColumn("date", day_of(F.col("created"))), "delivery_flag", by_created_day)


def call_overview_days(ivr_agg: DataFrame, scope: Scope, by_created_day: bool = False) -> DataFrame:
    """Rows, calls made and picked up per loan and day. The range applies to the day a call
    was created, the bucket is the day it started."""
    rows = scope.of_company(ivr_agg).where(
        F.col("start_time").isNotNull() & scope.days(F.to_date("created"))
    )
    return _overview(rows.withColumn("date", day_of(F.col("start_time"))), "call_pick", by_created_day)


def _overview(rows: DataFrame, delivered: str, by_created_day: bool) -> DataFrame:
    measures = {
        "loan_rows": F.count(F.lit(1)),
        "triggered": F.sum("trigger_count"),
        "delivered": F.sum(delivered),
    }
    if not by_created_day:
        return _by_loan(rows, False, measures)
    return _by_loan(rows.withColumn("created_day", F.to_date("created")), False, measures, "created_day")


# What the measures of both branches are combined from. Errors are always summed and taken off
# ``delivered``; a message has none.
RAW = ("triggered", "delivered", "opened", "responded", "ended", "clicked", "explicit", "errors")
_HOUR = ("company_id", "loan_id", "type_of_comm", "date", "hours")


def _raw(rows: DataFrame, measures: dict[str, Column]) -> DataFrame:
    return rows.select(*_HOUR, *[measures[name].cast("bigint").alias(name) for name in RAW])


def message_rows(msg_agg: DataFrame, scope: Scope) -> DataFrame:
    """Raw measures of each message aggregate row."""
    rows = scope.of_company(msg_agg).where(scope.days(F.to_date("created")))
    rows = rows.withColumns({"date": day_of(F.col("created")), "hours": hour_of(F.col("created"))})
    zero = F.lit(0)
    return _raw(
        rows,
        {
            "triggered": F.col("trigger_count"),
            "delivered": F.col("delivery_flag"),
            "opened": F.col("opened_flag"),
            "responded": zero,
            "ended": zero,
            "clicked": F.col("click_count"),
            "explicit": F.col("click_count"),
            "errors": zero,
        },
    )


def call_rows(ivr_agg: DataFrame, scope: Scope) -> DataFrame:
    """Raw measures of each call aggregate row."""
    started = F.col("start_time")
    rows = scope.of_company(ivr_agg).where(started.isNotNull() & scope.days(day_of(started)))
    rows = rows.withColumns({"date": day_of(started), "hours": hour_of(started)})
    return _raw(
        rows,
        {
            "triggered": F.col("trigger_count"),
            "delivered": F.col("trigger_count"),
            "opened": F.col("call_pick"),
            "responded": F.col("call_resp"),
            "ended": F.col("end_of_message_rate"),
            "clicked": F.lit(0),
            "explicit": (F.col("ivr_resp_state") == STATE_YES).cast("int"),
            "errors": F.col("error_flag"),
        },
    )


def both_rows(aggregate: DataFrame, scope: Scope) -> DataFrame:
    """Raw measures of each row of ``aggregate_both``: those of its own kind."""
    is_call = F.col("is_call")
    moment = F.when(is_call, F.col("start_time").cast("timestamp_ntz")).otherwise(F.col("created"))
    rows = scope.of_company(aggregate).withColumns({"date": day_of(moment), "hours": hour_of(moment)})

    def either(call: Column | str, message: Column | str) -> Column:
        as_column = lambda c: F.col(c) if isinstance(c, str) else c
        return F.when(is_call, as_column(call)).otherwise(as_column(message))

    zero, yes = F.lit(0), (F.col("ivr_resp_state") == STATE_YES).cast("int")
    return _raw(
        rows.where(scope.days(F.col("date"))),
        {
            "triggered": F.col("trigger_count"),
            "delivered": either("trigger_count", "delivery_flag"),
            "opened": either("call_pick", "opened_flag"),
            "responded": either("call_resp", zero),
            "ended": either("end_of_message_rate", zero),
            "clicked": either(zero, "click_count"),
            "explicit": either(yes, "click_count"),
            "errors": either("error_flag", zero),
        },
    )


def of_rows(rows: DataFrame, combine: str = "sum", by_hour: bool = False) -> DataFrame:
    """Measures per loan and day (or hour) from raw rows, in one aggregate."""
    pick = _COMBINE[combine]
    made = {name: pick(F.col(name)) for name in MEASURES}
    made["delivered"] = made["delivered"] - F.sum("errors")
    return _by_loan(rows, by_hour, made)


def both_overview_days(aggregate: DataFrame, scope: Scope) -> DataFrame:
    """Rows, triggered and delivered of either kind per loan and day, from ``aggregate_both``."""
    is_call = F.col("is_call")
    date = F.when(is_call, day_of(F.col("start_time"))).otherwise(F.to_date("created"))
    rows = scope.of_company(aggregate).where(scope.days(F.to_date("created"))).where(date.isNotNull())
    made = F.when(is_call, F.col("call_pick").cast("bigint")).otherwise(F.col("delivery_flag"))
    return _overview(rows.withColumn("date", date).withColumn("made", made), "made", False)


def loan_levels(rows: DataFrame) -> DataFrame:
    """Measures per loan and hour, and per loan and day, for every report at once.

    One aggregate over raw rows by two sets of keys: ``by_hour`` tells which a row is of, since an
    hour may be NULL itself. Each measure comes summed and as the largest value.
    """
    made = {f"{name}_{how}": pick(F.col(name)) for name in MEASURES for how, pick in _COMBINE.items()}
    for how in _COMBINE:
        made[f"delivered_{how}"] = made[f"delivered_{how}"] - F.sum("errors")
    by_hour = (F.grouping("hours") == 0).alias("by_hour")
    days = [key for key in _HOUR if key != "hours"]
    return rows.groupingSets([list(_HOUR), days], *_HOUR).agg(by_hour, *[m.alias(name) for name, m in made.items()])
