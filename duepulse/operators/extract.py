"""Facts from the operational tables.

Messages, calls and tags are filter and projection only: no shuffle. The
JSON column is parsed once per row, after the filters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from duepulse.functions import messages
from duepulse.operators.joins import left_join_splitting_both_sides
from duepulse.operators.scope import (
    EVERYTHING,
    IVR_CHANNEL,
    MESSAGE_CHANNELS,
    Scope,
    in_month,
    of_channels,
)
from duepulse.schemas import IVR_DATA, MSG_DATA, TAG_DATA

# Every leaf is read as text: a value may be an object or a scalar, and an
# object keeps its JSON text.
_MESSAGE_JSON = (
    "sms_language string, template_name string, delivered_time string, opened_time string, "
    "sms_verification_link_clicked_count string"
)
_CALL_JSON = (
    "dtmf_ivr_mobile string, start_time string, end_time string, call_duration string, "
    "ivr_response struct<scenarioName: string, collectedDtmfs: string, collectedMappedDtmfs: string>, "
    "error struct<groupName: string>"
)
_IVR_JSON = f"template_name string, {_CALL_JSON}"


def _with_json(rows: DataFrame, fields: str) -> DataFrame:
    """Adds the parsed payload. As the one element of an exploded array it is parsed once;
    as a plain column it would be parsed again by each later filter on one of its leaves."""
    return rows.select("*", F.explode(F.array(F.from_json("comm_dict", fields))).alias("json"))


def extract_messages(
    communication: DataFrame,
    scope: Scope = EVERYTHING,
    channels: Sequence[str] = MESSAGE_CHANNELS,
) -> DataFrame:
    """One row per WhatsApp or SMS message. Both channels come out of one scan."""
    rows = of_channels(scope.of_company(_as_text(communication, "company_id")), channels)
    rows = _with_json(rows.where(scope.days(F.to_date("created"))), _MESSAGE_JSON)
    clicks = F.col("json.sms_verification_link_clicked_count")
    return rows.select(
        "created",
        "company_id",
        "type_of_comm",
        "loan_id",
        messages.message_language(
            F.col("type_of_comm"), F.col("json.sms_language"), F.col("json.template_name")
        ).alias("comm_language"),
        messages.blank_to_null(F.col("json.delivered_time")).alias("delivery_status"),
        messages.blank_to_null(F.col("json.opened_time")).alias("opened_status"),
        clicks.cast("bigint").alias("click_count"),
    ).select(*MSG_DATA.names)


def extract_ivr(
    communication: DataFrame, scope: Scope = EVERYTHING, channel: str = IVR_CHANNEL
) -> DataFrame:
    """One row per IVR call that has an allocation month."""
    rows = of_channels(scope.of_company(_as_text(communication, "company_id")), [channel])
    rows = rows.where(scope.days(F.to_date("created"))).where(F.col("allocation_month") != "")
    return (
        _with_json(rows, _IVR_JSON)
        .select(
            "loan_id",
            F.col("json.dtmf_ivr_mobile").alias("mobile"),
            F.col("json.start_time").alias("start_time"),
            F.col("json.end_time").alias("end_time"),
            F.col("json.call_duration").alias("call_duration"),
            F.col("json.template_name").alias("template_name"),
            F.col("json.ivr_response.scenarioName").alias("scenario_name"),
            F.col("json.error.groupName").alias("error_nm"),
            F.col("json.ivr_response.collectedDtmfs").alias("collectedDtmfs"),
            F.col("json.ivr_response.collectedMappedDtmfs").alias("collectedMappedDtmfs"),
            "created",
            "company_id",
            "type_of_comm",
        )
        .select(*IVR_DATA.names)
    )


_BOTH_JSON = f"{_MESSAGE_JSON}, {_CALL_JSON}"


def extract_both(
    communication: DataFrame,
    scope: Scope = EVERYTHING,
    channels: Sequence[str] = MESSAGE_CHANNELS,
    ivr_channel: str = IVR_CHANNEL,
) -> DataFrame:
    """Messages and calls out of one scan, in one shape, with what the reports read of them.

    Fields of the other kind are NULL. ``is_call`` tells them apart.
    """
    rows = of_channels(scope.of_company(_as_text(communication, "company_id")), [*channels, ivr_channel])
    is_call = F.lower("type_of_comm") == ivr_channel.lower()
    rows = rows.where(scope.days(F.to_date("created")))
    rows = rows.where(~is_call | (F.col("allocation_month") != "")).withColumn("is_call", is_call)
    json = _with_json(rows, _BOTH_JSON)

    def of_call(field: str, name: str) -> Column:
        return F.when(F.col("is_call"), F.col(field)).alias(name)

    def of_message(value: Column, name: str) -> Column:
        return F.when(~F.col("is_call"), value).alias(name)

    return json.select(
        "is_call", "company_id", "loan_id", "created", "type_of_comm",
        of_message(messages.blank_to_null(F.col("json.delivered_time")), "delivery_status"),
        of_message(messages.blank_to_null(F.col("json.opened_time")), "opened_status"),
        of_message(F.col("json.sms_verification_link_clicked_count").cast("bigint"), "click_count"),
        of_call("json.start_time", "start_time"),
        of_call("json.call_duration", "call_duration"),
        of_call("json.error.groupName", "error_nm"),
        of_call("json.ivr_response.collectedDtmfs", "collectedDtmfs"),
        of_call("json.ivr_response.collectedMappedDtmfs", "collectedMappedDtmfs"),
    )


def _as_text(rows: DataFrame, name: str) -> DataFrame:
    """The column as text: JSON for a nested type. A text column stays as it is, without even
    an alias, so that two readers of the rows have the same plan and share its shuffle."""
    kind = rows.schema[name].dataType.typeName()
    if kind == "string":
        return rows
    nested = kind in ("struct", "map", "array", "variant")
    return rows.withColumn(name, F.to_json(name) if nested else F.col(name).cast("string"))


def extract_allocation(
    defaults: DataFrame,
    details: DataFrame,
    scope: Scope = EVERYTHING,
    allocation_month: str | None = None,
) -> DataFrame:
    """Defaulted loans of a month with contact data; a loan repeats per detail row."""
    loans = in_month(scope.of_company(_as_text(defaults, "company_id")), allocation_month)
    loans = loans.withColumn(
        "repayment_mode", F.get_json_object("additional_variables", "$.repayment_mode")
    ).drop("additional_variables")
    loans = _as_text(loans, "amount_recovered_breakdown")
    contact = F.from_json("loan_details", "mob string, applicant_contact_number string")
    contacts = (
        scope.of_company(_as_text(details, "company_id"))
        .withColumn("contact", contact)
        .select("company_id", "loan_id", "contact.mob", "contact.applicant_contact_number")
    )
    return left_join_splitting_both_sides(loans, contacts, ["company_id", "loan_id"])


def extract_tags(
    tags: DataFrame, scope: Scope = EVERYTHING, allocation_month: str | None = None
) -> DataFrame:
    """Loan tags of a month."""
    rows = in_month(scope.of_company(_as_text(tags, "company_id")), allocation_month)
    return rows.select(*TAG_DATA.names)
