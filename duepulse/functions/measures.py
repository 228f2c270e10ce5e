"""Expressions on sums and time buckets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` rounded half up to four places; NULL when ``whole`` is 0 or NULL.

    The division runs in decimals, so a tie in the fifth place is exact.
    """
    divisor = F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(part.cast("decimal(20,0)") / divisor, 4).cast("double")


def day_of(moment: Column) -> Column:
    """Day bucket of a timestamp, or of a timestamp in text form."""
    return moment.cast("date")


def hour_of(moment: Column) -> Column:
    return F.hour(moment.cast("timestamp_ntz"))


def month_number(month: Column) -> Column:
    """Month of the year, 1 to 12; the year plays no part. A blank month has none."""
    return F.month(F.nullif(month, F.lit("")).cast("date"))
