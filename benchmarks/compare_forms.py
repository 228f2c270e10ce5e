"""Times alternative forms of three plan choices, and checks that they agree.

    python benchmarks/compare_forms.py FOLDER

FOLDER holds the five source tables as Parquet, as bench.py writes them.
Prints one line per form: median seconds of three runs after a warm-up.
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window, functions as F  # noqa: E402

import bench  # noqa: E402
from duepulse.functions.measures import month_number  # noqa: E402
from duepulse.operators import loan_days, rollup, tagging  # noqa: E402
from duepulse.operators.aggregate import aggregate_messages  # noqa: E402
from duepulse.operators.extract import extract_messages  # noqa: E402
from duepulse.operators.scope import EVERYTHING  # noqa: E402
from duepulse.plans import reports  # noqa: E402


def tagged_per_click(days, tags, clicks):
    """One row per loan-day, tag row and matching click."""
    loan = tagging.LOAN
    dated = days.join(tags, loan, "left").withColumn("month_number", month_number(F.col("allocation_month")))
    matching = tagging.channel_clicks(clicks).select(
        *loan, "type_of_comm", F.month("created").alias("month_number")
    )
    joined = dated.join(matching, [*loan, "type_of_comm", "month_number"], "left")
    return joined.withColumn("weight", F.lit(1))


def main(folder: str) -> None:
    spark = bench.session()
    read = {
        name: spark.read.parquet(f"{folder}/{name}") for name in ("communication", "tags", "click_data")
    }
    tags, clicks = read["tags"], read["click_data"]
    scratch = tempfile.mkdtemp(prefix="duepulse-forms-")
    aggregate_messages(extract_messages(read["communication"])).write.parquet(f"{scratch}/msg_agg")
    msg_agg = spark.read.parquet(f"{scratch}/msg_agg")

    def days():
        return loan_days.message_loan_days(msg_agg, EVERYTHING)

    def weighted():
        return reports.datewise_response(msg_agg, None, tags, clicks)

    def multiplied():
        joined = tagged_per_click(days(), tags, clicks)
        return rollup.response_rollup(joined, tagging.tag_population(tags), False)

    # The two population forms stop at one sum per group.
    def population_after():
        copies = tagging.tag_copies(tags)
        rows = tagging.tagged(loan_days.message_loan_days(msg_agg, EVERYTHING, "max"), copies, "left")
        sums = rows.groupBy(*rollup.GROUP).agg(F.sum(F.col("triggered") * F.col("weight")).alias("sent"))
        return tagging.with_population(sums, tagging.population_of_copies(copies))

    def population_window():
        group = Window.partitionBy("company_id", "tag_name", "allocation_month")
        known = F.col("tag_name").isNotNull() & F.col("allocation_month").isNotNull()
        size = F.when(known, F.count("loan_id").over(group)).alias("max_triggered")
        rows = loan_days.message_loan_days(msg_agg, EVERYTHING, "max").join(
            tags.select("*", size), tagging.LOAN, "left"
        )
        return rows.groupBy(*rollup.GROUP, "max_triggered").agg(F.sum("triggered").alias("sent"))

    def key(df, *columns):
        return sorted(map(repr, df.select(*sorted(columns)).collect()))

    assert key(weighted(), *weighted().columns) == key(multiplied(), *weighted().columns)
    sized = (*rollup.GROUP, "sent", "max_triggered")
    assert key(population_after(), *sized) == key(population_window(), *sized)

    for name, form in (
        ("clicks as weight", weighted),
        ("clicks as joined rows", multiplied),
        ("population after the rollup", population_after),
        ("population as a window over tags", population_window),
    ):
        took = bench.median_seconds(lambda form=form: form().write.format("noop").mode("overwrite").save())
        print(f"{name}: {took}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1])
