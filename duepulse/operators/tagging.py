"""Joins of loan measures with tags, tag populations and link clicks.

A report counts a loan once for each of its tag rows, and, where clicks are
joined, once for each matching click. Instead of multiplying rows, equal tag
rows and matching clicks are counted before the join and the counts travel
along as a weight; the rollup multiplies sums by it. The join then emits at
most one row per loan-day and distinct tag, however many copies a tag or a
click has, and the copies collapse before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from duepulse.functions.links import click_channel
from duepulse.functions.measures import month_number

LOAN = ["company_id", "loan_id"]


def tag_copies(tag_data: DataFrame) -> DataFrame:
    """Distinct tags of a loan with the number of rows of each."""
    rows = tag_data.where(F.col("company_id").isNotNull() & F.col("loan_id").isNotNull())
    return rows.groupBy("company_id", "loan_id", "tag_name", "allocation_month").agg(
        F.count(F.lit(1)).alias("tag_rows")
    )


def tag_population(tag_data: DataFrame) -> DataFrame:
    """Tag rows with a loan per company, tag and month, over every day and month loaded."""
    return tag_data.groupBy("company_id", "tag_name", "allocation_month").agg(
        F.count("loan_id").alias("max_triggered")
    )


def population_of_copies(copies: DataFrame) -> DataFrame:
    """``tag_population`` from the counted tags. Equal to it wherever a loan has the tag."""
    return copies.groupBy("company_id", "tag_name", "allocation_month").agg(
        F.sum("tag_rows").alias("max_triggered")
    )


def with_population(rows: DataFrame, population: DataFrame) -> DataFrame:
    """Rows with the population of their tag; a NULL tag or month has none.

    The comparison treats NULLs as equal and blanks the result afterwards. A
    plain ``=`` would filter NULL tags out of one of the two reads of the
    tags, and they could no longer share a shuffle.
    """
    r, p = rows.alias("r"), population.alias("p")
    known = F.col("r.tag_name").isNotNull() & F.col("r.allocation_month").isNotNull()
    same = (
        (F.col("r.company_id") == F.col("p.company_id"))
        & F.col("r.tag_name").eqNullSafe(F.col("p.tag_name"))
        & F.col("r.allocation_month").eqNullSafe(F.col("p.allocation_month"))
    )
    return r.join(p, same, "left").select(
        "r.*", F.when(known, F.col("p.max_triggered")).alias("max_triggered")
    )


def channel_clicks(click_data: DataFrame) -> DataFrame:
    """Clicks whose link belongs to a message channel."""
    return (
        click_data.withColumn("type_of_comm", click_channel(F.col("link_tag")))
        .where(F.col("type_of_comm").isNotNull())
        .select("company_id", "loan_id", "created", "type_of_comm")
    )


def monthly_clicks(click_data: DataFrame) -> DataFrame:
    """Clicks per loan and month of the year, one column per channel."""
    clicks = channel_clicks(click_data)
    return clicks.groupBy(*LOAN, F.month("created").alias("month_number")).agg(
        F.count(F.when(F.col("type_of_comm") == "whatsapp", 1)).alias("whatsapp_clicks"),
        F.count(F.when(F.col("type_of_comm") == "sms", 1)).alias("sms_clicks"),
    )


def with_clicks(tags: DataFrame, click_data: DataFrame) -> DataFrame:
    """Tags with the clicks of their loan in the tag's month of the year."""
    dated = tags.withColumn("month_number", month_number(F.col("allocation_month")))
    return dated.join(monthly_clicks(click_data), [*LOAN, "month_number"], "left").drop("month_number")


def tagged(loan_days: DataFrame, tags: DataFrame, how: str) -> DataFrame:
    """Loan measures per tag with their ``weight``: the rows the plain joins would give.

    Untagged loans survive a left join with NULL tag and weight 1.
    """
    joined = loan_days.join(tags, LOAN, how)
    weight = F.coalesce("tag_rows", F.lit(1))
    if "whatsapp_clicks" in tags.columns:
        clicks = F.when(F.col("type_of_comm") == "whatsapp", F.col("whatsapp_clicks")).when(
            F.col("type_of_comm") == "sms", F.col("sms_clicks")
        )
        weight = weight * F.greatest(clicks, F.lit(1).cast("bigint"))
    return joined.withColumn("weight", weight)
