"""Small tables for tests: rows as dictionaries over defaults."""

from __future__ import annotations

import json
from datetime import datetime

from duepulse import schemas


def table(spark, schema, rows, **defaults):
    full = [{**dict.fromkeys(schema.names), **defaults, **row} for row in rows]
    return spark.createDataFrame([tuple(r[n] for n in schema.names) for r in full], schema)


def communication(spark, rows, **defaults):
    """``payload`` may be given as a dictionary in place of ``comm_dict``."""
    full = []
    for row in rows:
        row = {**defaults, **row}
        payload = row.pop("payload", None)
        if payload is not None:
            row["comm_dict"] = json.dumps(payload)
        full.append(row)
    base = {
        "company_id": "c",
        "loan_id": "L1",
        "created": datetime(2024, 1, 5, 9),
        "allocation_month": "2024-1-01",
        "comm_dict": "{}",
    }
    return table(spark, schemas.COMMUNICATION, full, **base)


def tags(spark, rows):
    return table(spark, schemas.TAGS, rows, company_id="c", loan_id="L1", allocation_month="2024-1-01")


def clicks(spark, rows):
    return table(
        spark, schemas.CLICK_DATA, rows, company_id="c", loan_id="L1", created=datetime(2024, 1, 9)
    )


def messages(spark, rows):
    return table(
        spark,
        schemas.MSG_AGG_DATA,
        rows,
        company_id="c",
        loan_id="L1",
        created=datetime(2024, 1, 5, 9),
        delivery_flag=1,
        opened_flag=0,
        trigger_count=1,
        type_of_comm="whatsapp",
    )


def calls(spark, rows):
    return table(
        spark,
        schemas.IVR_AGG_DATA,
        rows,
        company_id="c",
        loan_id="L1",
        created=datetime(2024, 1, 5, 9),
        start_time="2024-01-05 09:30:00",
        call_pick=0,
        call_resp=0,
        end_of_message_rate=0,
        ivr_resp_state=0,
        explicit_response="Wrong input",
        trigger_count=1,
        type_of_comm="dtmf_ivr",
        error_flag=0,
    )


def ivr_facts(spark, rows):
    return table(
        spark,
        schemas.IVR_DATA,
        rows,
        company_id="c",
        loan_id="L1",
        created=datetime(2024, 1, 5, 9),
        start_time="2024-01-05 09:30:00",
        call_duration="12",
        type_of_comm="dtmf_ivr",
    )
