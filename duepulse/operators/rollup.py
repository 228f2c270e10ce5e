"""Report rollups over tagged loan measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from duepulse.functions.measures import share
from duepulse.operators.tagging import with_population
from duepulse.schemas import CHANNEL_AGG_OVERVIEW, CHANNEL_RESPONSE, HOURWISE_CHANNEL_RESPONSE

GROUP = ("company_id", "allocation_month", "date", "tag_name", "type_of_comm")


def _weighted(measure: str) -> Column:
    """Sum of the measure over all copies of a row. NULLs stay out of the sum."""
    return F.sum(F.col(measure) * F.col("weight"))


def overview_sums(tagged_days: DataFrame, *more: str) -> DataFrame:
    return tagged_days.groupBy(*GROUP, *more).agg(
        _weighted("triggered").alias("total_comms_triggered"),
        _weighted("delivered").alias("total_comms_delivered"),
        _weighted("loan_rows").alias("loan_id_count"),
    )


def _with_share(sums: DataFrame) -> DataFrame:
    delivered = share(F.col("total_comms_delivered"), F.col("total_comms_triggered"))
    return sums.withColumn("delivery_percentage", delivered).select(*CHANNEL_AGG_OVERVIEW.names)


def overview_rollup(tagged_days: DataFrame) -> DataFrame:
    return _with_share(overview_sums(tagged_days))


def overview_totals(by_created_day: DataFrame) -> DataFrame:
    """The overview over all days that its sums were stored by."""
    counts = ("total_comms_triggered", "total_comms_delivered", "loan_id_count")
    return _with_share(by_created_day.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in counts]))


#: Report columns and the loan measures that they sum.
_SUMS = {
    "delivery_flag_sum": "delivered",
    "trigger_count_sum": "triggered",
    "opened_flag_sum": "opened",
    "responded_sum": "responded",
    "ended_sum": "ended",
    "click_flag_sum": "clicked",
    "explicit_sum": "explicit",
}


def _loans(weight: Column) -> Column:
    return F.sum(F.when(F.col("loan_id").isNotNull(), weight).otherwise(0))


def _with_shares(sized: DataFrame, by_hour: bool) -> DataFrame:
    triggered = F.col("trigger_count_sum")
    shares = {
        "response_percentage": share(F.col("responded_sum"), triggered),
        "eom_percentage": share(F.col("ended_sum"), triggered),
        "trigger_percentage": share(triggered, F.col("max_triggered")),
        "delivery_percentage": share(F.col("delivery_flag_sum"), triggered),
        "react_percentage": share(F.col("opened_flag_sum"), triggered),
        "explicit_response_percentage": share(F.col("explicit_sum"), triggered),
    }
    schema = HOURWISE_CHANNEL_RESPONSE if by_hour else CHANNEL_RESPONSE
    return sized.withColumns(shares).select(*schema.names)


def response_rollup(tagged_days: DataFrame, population: DataFrame, by_hour: bool) -> DataFrame:
    """Sums and shares per tag, day [and hour] and channel.

    The population of a tag depends on the group alone, so it joins the rolled
    up rows and not the loans. A NULL tag or month has no population.
    """
    keys = [*GROUP, *(["hours"] if by_hour else [])]
    sums = tagged_days.groupBy(*keys).agg(
        _loans(F.col("weight")).alias("loan_id_count"),
        *[_weighted(measure).alias(name) for name, measure in _SUMS.items()],
    )
    return _with_shares(with_population(sums, population), by_hour)


def response_sums(tagged_levels: DataFrame, population: DataFrame) -> DataFrame:
    """What all three response reports are made from, with the population, in one rollup.

    Takes ``loan_levels`` with their tags and clicks. Only the sums of a day count a loan once per
    click; its largest values and the sums of an hour count it once per tag row.
    """
    by_tag = F.coalesce("tag_rows", F.lit(1).cast("bigint"))
    weights = {"sum": F.when(F.col("by_hour"), by_tag).otherwise(F.col("weight")), "max": by_tag}
    made = []
    for how, weight in weights.items():
        made.append(_loans(weight).alias(f"loan_id_count_{how}"))
        made += [F.sum(F.col(f"{measure}_{how}") * weight).alias(f"{name}_{how}") for name, measure in _SUMS.items()]
    return with_population(tagged_levels.groupBy(*GROUP, "hours", "by_hour").agg(*made), population)


def response_of_sums(sums: DataFrame, combine: str, by_hour: bool = False) -> DataFrame:
    """One report from ``response_sums``: no shuffle, only its rows and columns."""
    level = F.col("by_hour") if by_hour else ~F.col("by_hour")
    columns = [F.col(f"{name}_{combine}").alias(name) for name in ("loan_id_count", *_SUMS)]
    return _with_shares(sums.where(level).select(*GROUP, "hours", "max_triggered", *columns), by_hour)
