"""Expressions on IVR calls."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Answers that mean the message was not heard to its end, the
# response states, their labels, the error class that is the callee's own
# doing, and the seconds after which a call counts as responded.
NO_DIGITS = "{}"
UNHEARD_ANSWERS = ("{}", "0")
STATE_UNHEARD = -1
STATE_OTHER = 0
STATE_YES = 1
STATE_NO = 2
STATE_LABELS = {
    STATE_UNHEARD: "EOM not reached",
    STATE_YES: "responded yes",
    STATE_NO: "responded no",
}
OTHER_LABEL = "Wrong input"
USER_ERROR_CLASS = "user_errors"
RESPONSE_SECONDS = 10


def _flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def call_seconds(call_duration: Column, bad_durations: str = "fail") -> Column:
    """Duration as an integer. Unreadable text stops the job, whatever the session's settings;
    ``bad_durations='null'`` treats it as missing."""
    if bad_durations not in ("fail", "null"):
        raise ValueError(f"bad_durations must be 'fail' or 'null', not {bad_durations!r}")
    seconds = call_duration.try_cast("int")
    if bad_durations == "null":
        return seconds
    told = F.raise_error(F.concat(F.lit("call_duration is not a whole number: "), call_duration))
    return F.when(call_duration.isNotNull() & seconds.isNull(), told.cast("int")).otherwise(seconds)


def call_picked(seconds: Column) -> Column:
    return _flag(seconds > 0)


def call_responded(seconds: Column) -> Column:
    return _flag(seconds >= RESPONSE_SECONDS)


def end_of_message(digits: Column) -> Column:
    """0 if the call collected an empty set of digits, else 1, also where nothing was stored."""
    return 1 - _flag(digits == NO_DIGITS)


def response_state(mapped_digits: Column) -> Column:
    """-1 not heard, 1 yes, 2 no, 0 anything else. A text with both words is a yes."""
    answer = F.lower(mapped_digits)
    return (
        F.when(mapped_digits.isin(*UNHEARD_ANSWERS), STATE_UNHEARD)
        .when(answer.contains("yes"), STATE_YES)
        .when(answer.contains("no"), STATE_NO)
        .otherwise(STATE_OTHER)
    )


def state_label(state: Column) -> Column:
    labels = [F.when(state == code, F.lit(text)) for code, text in STATE_LABELS.items()]
    return F.coalesce(*labels, F.lit(OTHER_LABEL))


def error_flag(error_class: Column) -> Column:
    """1 for a delivery error; a missing class or the callee's own error is 0."""
    return _flag(F.lower(error_class) != USER_ERROR_CLASS)
