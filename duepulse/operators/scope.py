"""Which rows a run covers: company, days, channels.

A run may name one company and an inclusive range of days. Left out, it
covers every company or every day in a single job. Rows that no such run
could reach, those with a NULL company or day, are left out in both forms.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

MESSAGE_CHANNELS = ("whatsapp", "sms")
IVR_CHANNEL = "dtmf_ivr"


@dataclass(frozen=True)
class Scope:
    company_id: str | None = None
    start: str | None = None
    end: str | None = None

    def of_company(self, rows: DataFrame) -> DataFrame:
        company = F.col("company_id")
        return rows.where(company.isNotNull() if self.company_id is None else company == self.company_id)

    def days(self, day: Column) -> Column:
        """Inclusive range on a day. A cast from a timestamp column stays pushable to the scan."""
        condition = day.isNotNull()
        if self.start is not None:
            condition &= day >= F.lit(self.start).cast("date")
        if self.end is not None:
            condition &= day <= F.lit(self.end).cast("date")
        return condition


EVERYTHING = Scope()


def of_channels(rows: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Rows of the named channels, whatever the case of the stored name.

    A comparison of ``lower(...)`` can't be pushed to a scan; staged tables have a folder level
    for the channel instead.
    """
    return rows.where(F.lower("type_of_comm").isin(*[c.lower() for c in channels]))


def in_month(rows: DataFrame, allocation_month: str | None) -> DataFrame:
    """Rows whose month text equals the parameter exactly; ``None`` keeps every month."""
    if allocation_month is None:
        return rows.where(F.col("allocation_month").isNotNull())
    return rows.where(F.col("allocation_month") == allocation_month)
