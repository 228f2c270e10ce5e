"""Declared schemas of the source, staging, aggregate and report tables.

Columns always bind by name. ``allocation_data`` has no entry: it carries
whatever columns the loan-default table has.
"""

from __future__ import annotations

from pyspark.sql.types import StructType


def _schema(columns: str) -> StructType:
    """From ``name type`` pairs; the types are Spark's JSON type names."""
    schema = StructType()
    for column in columns.split(","):
        name, type_name = column.split()
        schema = schema.add(name, type_name)
    return schema


COMMUNICATION = _schema(
    "company_id string, loan_id string, type_of_comm string, created timestamp_ntz, "
    "allocation_month string, comm_dict string"
)
TAGS = _schema("company_id string, loan_id string, tag_name string, allocation_month string")
CLICK_DATA = _schema("company_id string, loan_id string, created timestamp_ntz, link_tag string")

MSG_DATA = _schema(
    "created timestamp_ntz, company_id string, type_of_comm string, loan_id string, "
    "comm_language string, delivery_status string, opened_status string, click_count long"
)
IVR_DATA = _schema(
    "loan_id string, mobile string, start_time string, end_time string, call_duration string, "
    "template_name string, scenario_name string, error_nm string, collectedDtmfs string, "
    "collectedMappedDtmfs string, created timestamp_ntz, company_id string, type_of_comm string"
)
TAG_DATA = TAGS

MSG_AGG_DATA = _schema(
    "loan_id string, created timestamp_ntz, company_id string, comm_language string, "
    "delivery_flag long, opened_flag long, trigger_count long, click_count long, "
    "type_of_comm string"
)
IVR_AGG_DATA = _schema(
    "loan_id string, call_pick integer, call_resp integer, end_of_message_rate integer, ivr_resp_state integer, "
    "explicit_response string, trigger_count long, created timestamp_ntz, company_id string, "
    "start_time string, type_of_comm string, error_flag integer"
)

CHANNEL_AGG_OVERVIEW = _schema(
    "company_id string, allocation_month string, type_of_comm string, date date, tag_name string, "
    "total_comms_triggered long, total_comms_delivered long, delivery_percentage double, "
    "loan_id_count long"
)
_MEASURES = (
    "tag_name string, type_of_comm string, loan_id_count long, delivery_flag_sum long, "
    "trigger_count_sum long, opened_flag_sum long, response_percentage double, "
    "eom_percentage double, click_flag_sum long, trigger_percentage double, "
    "delivery_percentage double, react_percentage double, explicit_response_percentage double, "
    "max_triggered long"
)
CHANNEL_RESPONSE = _schema(f"company_id string, allocation_month string, date date, {_MEASURES}")
HOURWISE_CHANNEL_RESPONSE = _schema(
    f"company_id string, allocation_month string, date date, hours integer, {_MEASURES}"
)
# The overview as a run stores it: sums for each day the message or call was created.
OVERVIEW_BY_CREATED_DAY = _schema(
    "company_id string, allocation_month string, type_of_comm string, date date, tag_name string, "
    "total_comms_triggered long, total_comms_delivered long, loan_id_count long, created_day date"
)
# Sums of the response reports per day and per hour: of the loans' sums and of their largest values.
RESPONSE_SUMS = _schema(
    "company_id string, allocation_month string, date date, tag_name string, type_of_comm string, hours integer, "
    "by_hour boolean, max_triggered long, "
    + ", ".join(
        f"{name}_{how} long"
        for how in ("sum", "max")
        for name in (
            "loan_id_count", "delivery_flag_sum", "trigger_count_sum", "opened_flag_sum", "responded_sum",
            "ended_sum", "click_flag_sum", "explicit_sum",
        )
    )
)
