"""The five source tables, derived from the sample Parquet tables.

Every row of ``events``, ``customer`` and ``orders`` takes part. Each user is
a borrower, each event a message or a call, each order a default. What makes
a loan untagged, a call repeated or a contact missing is a value of the row,
such as its balance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duepulse.plans.run import Sources


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _loan(person: str) -> tuple[str, str]:
    return f"concat('co-', {person} % 3) AS company_id", f"concat('L', {person}) AS loan_id"


# Pieces of the payload, in order; NULL leaves are spelled out as JSON null.
_PAYLOAD = (
    """ '{"sms_language":"', if(event_id % 2 = 0, 'en', 'hi') """,
    """ '","template_name":"', element_at(array('due_Tamil_v1', 'due_KANNADA', 'due_bengali',
        'due_telugunew', 'due_telugu', 'due_english'), int((event_id * 7 + user_id) % 6 + 1)) """,
    """ '","delivered_time":"', if(event_id % 5 = 0, '', concat(day, ' 10:00:00')) """,
    """ '","opened_time":', if(event_id % 3 = 0, 'null', '"x"') """,
    """ ',"sms_verification_link_clicked_count":', if(event_id % 4 = 0, 'null', string(event_id % 4)) """,
    """ ',"dtmf_ivr_mobile":"9', lpad(user_id, 9, '0') """,
    """ '","start_time":', if(event_id % 13 = 0, 'null', concat('"', started, ' ', hh, ':15:00"')) """,
    """ ',"end_time":"', started, ' ', hh, ':45:00' """,
    """ '","call_duration":"', if(event_id % 41 = 0, 'n/a', string(event_id % 25)) """,
    """ '","ivr_response":{"scenarioName":"s1","collectedDtmfs":',
        CASE event_id % 6 WHEN 0 THEN '{}' WHEN 1 THEN 'null' ELSE '{"1":"1"}' END """,
    """ ',"collectedMappedDtmfs":', element_at(array('{}', '"0"', '{"1":"Yes"}', '{"1":"NO"}',
        '{"1":"9"}', 'null', '{"1":"no then yes"}'), int(event_id % 7 + 1)) """,
    """ '},"error":{"groupName":',
        CASE event_id % 9 WHEN 0 THEN '"SYSTEM"' WHEN 1 THEN '"USER_ERRORS"' ELSE 'null' END, '}}' """,
)


def communication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages and calls; an event of value 150 or more was sent twice.

    Some calls start the day after they were created, have no readable duration, or no loan.
    """
    return (
        _table(spark, sf_dir, "events")
        .selectExpr(
            "event_id",
            "user_id",
            "event_type",
            "explode(if(value >= 150, array(1, 2), array(1))) AS copy",
            "string(date(ts)) AS day",
            "hour(ts) AS hour",
            "lpad(hour(ts), 2, '0') AS hh",
            "string(date(ts) + int(event_id % 10 = 7)) AS started",
        )
        .selectExpr(
            _loan("user_id")[0],
            "if(event_id % 43 = 0, NULL, concat('L', user_id)) AS loan_id",
            """CASE WHEN event_type IN ('click', 'signup') THEN if(event_id % 11 = 0, 'WhatsApp', 'whatsapp')
                    WHEN event_type = 'view' THEN if(event_id % 11 = 0, 'SMS', 'sms')
                    ELSE 'dtmf_ivr' END AS type_of_comm""",
            "cast(concat(day, ' ', lpad(hour - hour % 6, 2, '0'), ':00:00') AS timestamp_ntz) AS created",
            """CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 19 = 0 THEN NULL
                    ELSE '2024-1-01' END AS allocation_month""",
            f"concat({', '.join(_PAYLOAD)}) AS comm_dict",
        )
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags by balance: none below 0, more tags and months as it grows, and a repeated tag."""
    # Least balance, name and month of each tag; a NULL name stands for the market segment.
    return (
        _table(spark, sf_dir, "customer")
        .selectExpr(
            *_loan("c_custkey"),
            "c_mktsegment",
            "c_acctbal",
            """inline(array(
                named_struct('least', 0, 'tag', string(NULL), 'month', '2024-1-01'),
                named_struct('least', 6000, 'tag', 'RETARGET', 'month', '2024-1-01'),
                named_struct('least', 7000, 'tag', 'UNSORTED', 'month', ''),
                named_struct('least', 8000, 'tag', 'RETARGET', 'month', '2024-2-01'),
                named_struct('least', 9000, 'tag', 'RETARGET', 'month', '2024-1-01')))""",
        )
        .where("c_acctbal >= least")
        .selectExpr(
            "company_id", "loan_id", "coalesce(tag, c_mktsegment) AS tag_name", "month AS allocation_month"
        )
    )


def click_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events; a quarter of the links belongs to no message channel, a sixth is a year later."""
    return (
        _table(spark, sf_dir, "events")
        .where("event_type = 'click'")
        .selectExpr(
            *_loan("user_id"),
            "if(event_id % 6 = 5, ts + INTERVAL 1 YEAR, ts) AS created",
            """element_at(array('x_predue_1_wa_a', 'predue_sms', 'predue_z_sms_b', 'postdue_wa'),
                          int(event_id % 4 + 1)) AS link_tag""",
        )
    )


def lending_default_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        *_loan("o_custkey"),
        "o_orderkey AS default_id",
        "if(o_orderkey % 3 = 0, '2024-2-01', '2024-1-01') AS allocation_month",
        """concat('{"repayment_mode":', if(o_orderkey % 4 = 0, 'null',
                  concat('"', lower(o_orderstatus), '"')), '}') AS additional_variables""",
        """concat('{"principal":', o_orderkey % 100, '}') AS amount_recovered_breakdown""",
    )


def lending_loan_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts by balance: none below 0, and two rows from 9500 on."""
    return (
        _table(spark, sf_dir, "customer")
        .where("c_acctbal >= 0")
        .selectExpr("c_custkey", "explode(if(c_acctbal >= 9500, array(0, 1), array(0))) AS extra")
        .selectExpr(
            *_loan("c_custkey"),
            """concat('{"mob":"', c_custkey % 24 + extra, '","applicant_contact_number":',
                      if(c_custkey % 6 = 0, 'null', concat('"9', lpad(c_custkey, 9, '0'), '"')), '}')
               AS loan_details""",
        )
    )


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(
        communication=communication(spark, sf_dir),
        lending_default_details=lending_default_details(spark, sf_dir),
        lending_loan_details=lending_loan_details(spark, sf_dir),
        tags=tags(spark, sf_dir),
        click_data=click_data(spark, sf_dir),
    )
