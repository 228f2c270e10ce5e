"""The four reports by tag, month and channel.

Each takes the message and the call aggregate, either of which may be left
out, and unites them before the joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from duepulse.operators import loan_days, rollup, tagging
from duepulse.operators.aggregate import aggregate_both
from duepulse.operators.extract import extract_both
from duepulse.operators.scope import EVERYTHING, Scope
from duepulse.schemas import OVERVIEW_BY_CREATED_DAY


def _united(branches: list[DataFrame | None]) -> DataFrame:
    given = [b for b in branches if b is not None]
    if not given:
        raise ValueError("a report needs the message aggregate, the call aggregate, or both")
    return reduce(DataFrame.unionByName, given)


def channel_overview(
    msg_agg: DataFrame | None,
    ivr_agg: DataFrame | None,
    tag_data: DataFrame,
    scope: Scope = EVERYTHING,
    by_created_day: bool = False,
) -> DataFrame:
    """Triggered and delivered counts of tagged loans per tag, day and channel.

    With ``by_created_day`` the sums alone, apart for each day a message or call was created.
    """
    days = _united(
        [
            None if msg_agg is None else loan_days.message_overview_days(msg_agg, scope, by_created_day),
            None if ivr_agg is None else loan_days.call_overview_days(ivr_agg, scope, by_created_day),
        ]
    )
    tagged = tagging.tagged(days, tagging.tag_copies(scope.of_company(tag_data)), "inner")
    if by_created_day:
        return rollup.overview_sums(tagged, "created_day").select(*OVERVIEW_BY_CREATED_DAY.names)
    return rollup.overview_rollup(tagged)


def overview(days: DataFrame, tag_data: DataFrame, scope: Scope = EVERYTHING) -> DataFrame:
    """The overview of counts per loan and day."""
    tags = tagging.tag_copies(scope.of_company(tag_data))
    return rollup.overview_rollup(tagging.tagged(days, tags, "inner"))


def response(
    days: DataFrame,
    tag_data: DataFrame,
    scope: Scope = EVERYTHING,
    by_hour: bool = False,
    click_data: DataFrame | None = None,
) -> DataFrame:
    """The response report of loan measures per day, or per hour."""
    copies = tagging.tag_copies(scope.of_company(tag_data))
    tags = copies
    if click_data is not None:
        tags = tagging.with_clicks(copies, scope.of_company(click_data))
    return rollup.response_rollup(
        tagging.tagged(days, tags, "left"), tagging.population_of_copies(copies), by_hour
    )


def response_sums(
    levels: DataFrame, tag_data: DataFrame, click_data: DataFrame, scope: Scope = EVERYTHING
) -> DataFrame:
    """The sums of all three response reports from ``loan_levels``: tags are joined once."""
    copies = tagging.tag_copies(scope.of_company(tag_data))
    tags = tagging.with_clicks(copies, scope.of_company(click_data))
    return rollup.response_sums(tagging.tagged(levels, tags, "left"), tagging.population_of_copies(copies))


def _response(
    msg_agg: DataFrame | None,
    ivr_agg: DataFrame | None,
    tag_data: DataFrame,
    scope: Scope,
    combine: str,
    by_hour: bool = False,
    click_data: DataFrame | None = None,
) -> DataFrame:
    days = _united(
        [
            None if msg_agg is None else loan_days.message_loan_days(msg_agg, scope, combine, by_hour),
            None if ivr_agg is None else loan_days.call_loan_days(ivr_agg, scope, combine, by_hour),
        ]
    )
    return response(days, tag_data, scope, by_hour, click_data)


def channel_connectivity(
    msg_agg: DataFrame | None,
    ivr_agg: DataFrame | None,
    tag_data: DataFrame,
    scope: Scope = EVERYTHING,
) -> DataFrame:
    """Reach per tag, day and channel, from the largest value of each loan-day."""
    return _response(msg_agg, ivr_agg, tag_data, scope, "max")


def datewise_response(
    msg_agg: DataFrame | None,
    ivr_agg: DataFrame | None,
    tag_data: DataFrame,
    click_data: DataFrame,
    scope: Scope = EVERYTHING,
) -> DataFrame:
    """Response per tag, day and channel. A message loan-day counts once per matching click."""
    return _response(msg_agg, ivr_agg, tag_data, scope, "sum", click_data=click_data)


def hourwise_response(
    msg_agg: DataFrame | None,
    ivr_agg: DataFrame | None,
    tag_data: DataFrame,
    scope: Scope = EVERYTHING,
) -> DataFrame:
    """Response per tag, day, hour and channel."""
    return _response(msg_agg, ivr_agg, tag_data, scope, "sum", by_hour=True)


def from_communication(
    name: str,
    communication: DataFrame,
    tag_data: DataFrame,
    click_data: DataFrame | None = None,
    scope: Scope = EVERYTHING,
    bad_durations: str = "fail",
) -> DataFrame:
    """The named report straight from the events: one scan and one aggregate for both branches."""
    both = aggregate_both(extract_both(communication, scope), scope, bad_durations=bad_durations)
    if name == "channel_overview":
        return overview(loan_days.both_overview_days(both, scope), tag_data, scope)
    combine = "max" if name == "channel_connectivity" else "sum"
    by_hour = name == "hourwise_response"
    days = loan_days.of_rows(loan_days.both_rows(both, scope), combine, by_hour)
    return response(days, tag_data, scope, by_hour, click_data if name == "datewise_response" else None)
