"""The reports computed row by row in Python, joins and all, for small tables."""

from __future__ import annotations

import re
from collections import defaultdict
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal


def share(part, whole):
    if part is None or not whole:
        return None
    exact = (Decimal(part) / Decimal(whole)).quantize(Decimal("0.0001"), ROUND_HALF_UP)
    return float(exact)


def total(values):
    there = [v for v in values if v is not None]
    return sum(there) if there else None


def largest(values):
    there = [v for v in values if v is not None]
    return max(there) if there else None


def _tags_of(row, tags):
    return [t for t in tags if t["company_id"] == row["company_id"] and t["loan_id"] == row["loan_id"] and t["loan_id"]]


def _click_channel(tag):
    if tag and re.fullmatch(r".*predue.*.wa.*", tag):
        return "whatsapp"
    return "sms" if tag and re.fullmatch(r".*predue.*.sms.*", tag) else None


def _month(text):
    return int(text.split("-")[1])


def _start(row):
    return datetime.fromisoformat(row["start_time"]) if row["start_time"] else None


def _loan_days(rows, moment, by_hour, build):
    groups = defaultdict(list)
    for r in rows:
        when = moment(r)
        if when is not None:
            groups[r["company_id"], r["loan_id"], r["type_of_comm"], when.date(), when.hour if by_hour else None].append(r)
    return [
        dict(zip(("company_id", "loan_id", "type_of_comm", "date", "hours"), key), **build(members))
        for key, members in groups.items()
    ]


def message_days(rows, pick, by_hour):
    def build(members):
        clicks = pick(m["click_count"] for m in members)
        return {
            "triggered": pick(m["trigger_count"] for m in members),
            "delivered": pick(m["delivery_flag"] for m in members),
            "opened": pick(m["opened_flag"] for m in members),
            "responded": 0,
            "ended": 0,
            "clicked": clicks,
            "explicit": clicks,
        }

    return _loan_days(rows, lambda r: r["created"], by_hour, build)


def call_days(rows, pick, by_hour):
    def build(members):
        triggered = pick(m["trigger_count"] for m in members)
        return {
            "triggered": triggered,
            "delivered": triggered - sum(m["error_flag"] for m in members),
            "opened": pick(m["call_pick"] for m in members),
            "responded": pick(m["call_resp"] for m in members),
            "ended": pick(m["end_of_message_rate"] for m in members),
            "clicked": 0,
            "explicit": pick(int(m["ivr_resp_state"] == 1) for m in members),
        }

    return _loan_days(rows, _start, by_hour, build)


def in_days(day: date, first: date | None, last: date | None) -> bool:
    return (first is None or day >= first) and (last is None or day <= last)


def response(days, tags, clicks, company, first, last, by_hour):
    """``clicks`` is None for reports without a click join."""
    joined = []
    for d in days:
        if d["company_id"] is None or (company and d["company_id"] != company) or not in_days(d["date"], first, last):
            continue
        for t in _tags_of(d, tags) or [None]:
            tag, month = (t["tag_name"], t["allocation_month"]) if t else (None, None)
            copies = 1
            if clicks is not None and month is not None:
                matching = [
                    c
                    for c in clicks
                    if c["company_id"] == d["company_id"]
                    and c["loan_id"] == d["loan_id"]
                    and c["created"].month == _month(month)
                    and _click_channel(c["link_tag"]) == d["type_of_comm"]
                ]
                copies = max(1, len(matching))
            population = None
            if tag is not None and month is not None:
                population = sum(
                    1
                    for x in tags
                    if x["loan_id"] is not None
                    and (x["company_id"], x["tag_name"], x["allocation_month"]) == (d["company_id"], tag, month)
                )
            joined += [(d, tag, month, population)] * copies
    groups = defaultdict(list)
    for d, tag, month, population in joined:
        groups[d["company_id"], month, d["date"], d["hours"], tag, d["type_of_comm"], population].append(d)
    result = []
    for (company_id, month, day, hours, tag, channel, population), members in groups.items():
        sums = {m: total(x[m] for x in members) for m in members[0] if m not in _KEYS}
        triggered = sums["triggered"]
        row = {
            "company_id": company_id,
            "allocation_month": month,
            "date": day,
            "tag_name": tag,
            "type_of_comm": channel,
            "loan_id_count": sum(1 for x in members if x["loan_id"] is not None),
            "delivery_flag_sum": sums["delivered"],
            "trigger_count_sum": triggered,
            "opened_flag_sum": sums["opened"],
            "response_percentage": share(sums["responded"], triggered),
            "eom_percentage": share(sums["ended"], triggered),
            "click_flag_sum": sums["clicked"],
            "trigger_percentage": share(triggered, population),
            "delivery_percentage": share(sums["delivered"], triggered),
            "react_percentage": share(sums["opened"], triggered),
            "explicit_response_percentage": share(sums["explicit"], triggered),
            "max_triggered": population,
        }
        if by_hour:
            row["hours"] = hours
        result.append(row)
    return result


_KEYS = ("company_id", "loan_id", "type_of_comm", "date", "hours")


def overview(rows, tags, delivered, bucket, company, first, last):
    groups = defaultdict(list)
    for r in rows:
        when = bucket(r)
        if when is None or r["company_id"] is None or (company and r["company_id"] != company):
            continue
        if r["created"] is None or not in_days(r["created"].date(), first, last):
            continue
        for t in _tags_of(r, tags):
            groups[r["company_id"], t["allocation_month"], r["type_of_comm"], when.date(), t["tag_name"]].append(r)
    result = []
    for (company_id, month, channel, day, tag), members in groups.items():
        triggered = total(m["trigger_count"] for m in members)
        reached = total(m[delivered] for m in members)
        result.append(
            {
                "company_id": company_id,
                "allocation_month": month,
                "type_of_comm": channel,
                "date": day,
                "tag_name": tag,
                "total_comms_triggered": triggered,
                "total_comms_delivered": reached,
                "delivery_percentage": share(reached, triggered),
                "loan_id_count": len(members),
            }
        )
    return result


def message_overview(rows, tags, *window):
    return overview(rows, tags, "delivery_flag", lambda r: r["created"], *window)


def call_overview(rows, tags, *window):
    return overview(rows, tags, "call_pick", _start, *window)
