"""The registered queries as SQL for DuckDB, written as plain joins.

The SQL multiplies rows where the engine carries weights, joins the
population before the rollup where the engine joins it afterwards, and runs
one branch after the other where the engine unites them, so the two agree
only if those rewrites are right.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- sample source tables ---------------------------------------------------

_COMMUNICATION = """
SELECT 'co-' || (user_id % 3) AS company_id,
       if(event_id % 43 = 0, NULL, 'L' || user_id) AS loan_id,
       CASE WHEN event_type IN ('click', 'signup') THEN if(event_id % 11 = 0, 'WhatsApp', 'whatsapp')
            WHEN event_type = 'view' THEN if(event_id % 11 = 0, 'SMS', 'sms')
            ELSE 'dtmf_ivr' END AS type_of_comm,
       CAST(ts AS DATE) + to_hours(CAST(hour(ts) - hour(ts) % 6 AS INTEGER)) AS created,
       CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 19 = 0 THEN NULL ELSE '2024-1-01' END
         AS allocation_month,
       '{"sms_language":"' || if(event_id % 2 = 0, 'en', 'hi')
       || '","template_name":"' || ['due_Tamil_v1', 'due_KANNADA', 'due_bengali', 'due_telugunew',
                                   'due_telugu', 'due_english'][(event_id * 7 + user_id) % 6 + 1]
       || '","delivered_time":"' || if(event_id % 5 = 0, '', strftime(ts, '%Y-%m-%d 10:00:00'))
       || '","opened_time":' || if(event_id % 3 = 0, 'null', '"x"')
       || ',"sms_verification_link_clicked_count":'
       || if(event_id % 4 = 0, 'null', CAST(event_id % 4 AS VARCHAR))
       || ',"dtmf_ivr_mobile":"9' || lpad(CAST(user_id AS VARCHAR), 9, '0')
       || '","start_time":' || if(event_id % 13 = 0, 'null', strftime(started, '"%Y-%m-%d %H:15:00"'))
       || ',"end_time":' || strftime(started, '"%Y-%m-%d %H:45:00"')
       || ',"call_duration":"' || if(event_id % 41 = 0, 'n/a', CAST(event_id % 25 AS VARCHAR))
       || '","ivr_response":{"scenarioName":"s1","collectedDtmfs":'
       || CASE event_id % 6 WHEN 0 THEN '{}' WHEN 1 THEN 'null' ELSE '{"1":"1"}' END
       || ',"collectedMappedDtmfs":'
       || ['{}', '"0"', '{"1":"Yes"}', '{"1":"NO"}', '{"1":"9"}', 'null', '{"1":"no then yes"}']
          [event_id % 7 + 1]
       || '},"error":{"groupName":'
       || CASE event_id % 9 WHEN 0 THEN '"SYSTEM"' WHEN 1 THEN '"USER_ERRORS"' ELSE 'null' END
       || '}}' AS comm_dict
FROM (SELECT *, ts + to_days(CAST(event_id % 10 = 7 AS INTEGER)) AS started
      FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE value >= 150))
"""

_TAGS = """
SELECT 'co-' || (c_custkey % 3) AS company_id, 'L' || c_custkey AS loan_id,
       coalesce(k.tag, c_mktsegment) AS tag_name, k.month AS allocation_month
FROM customer
JOIN (VALUES (0, NULL, '2024-1-01'), (6000, 'RETARGET', '2024-1-01'),
             (7000, 'UNSORTED', ''), (8000, 'RETARGET', '2024-2-01'), (9000, 'RETARGET', '2024-1-01')) k(least, tag, month)
  ON c_acctbal >= k.least
"""

_CLICK_DATA = """
SELECT 'co-' || (user_id % 3) AS company_id, 'L' || user_id AS loan_id,
       if(event_id % 6 = 5, ts + INTERVAL 1 YEAR, ts) AS created,
       ['x_predue_1_wa_a', 'predue_sms', 'predue_z_sms_b', 'postdue_wa'][event_id % 4 + 1] AS link_tag
FROM events WHERE event_type = 'click'
"""

_DEFAULTS = """
SELECT 'co-' || (o_custkey % 3) AS company_id, 'L' || o_custkey AS loan_id, o_orderkey AS default_id,
       if(o_orderkey % 3 = 0, '2024-2-01', '2024-1-01') AS allocation_month,
       '{"repayment_mode":' || if(o_orderkey % 4 = 0, 'null', '"' || lower(o_orderstatus) || '"') || '}'
         AS additional_variables,
       '{"principal":' || (o_orderkey % 100) || '}' AS amount_recovered_breakdown
FROM orders
"""

_DETAILS = """
SELECT 'co-' || (c_custkey % 3) AS company_id, 'L' || c_custkey AS loan_id,
       '{"mob":"' || (c_custkey % 24 + k.extra) || '","applicant_contact_number":'
       || if(c_custkey % 6 = 0, 'null', '"9' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '"') || '}'
         AS loan_details
FROM customer JOIN (VALUES (0, 0), (9500, 1)) k(least, extra) ON c_acctbal >= k.least
"""


# --- what a run covers ------------------------------------------------------


@dataclass(frozen=True)
class Window:
    company: str | None = None
    first: str | None = None
    last: str | None = None
    month: str | None = None

    def own(self, column: str = "company_id") -> str:
        return f"{column} = '{self.company}'" if self.company else f"{column} IS NOT NULL"

    def days(self, day: str) -> str:
        if self.first is None:
            return f"{day} IS NOT NULL"
        return f"{day} BETWEEN DATE '{self.first}' AND DATE '{self.last}'"

    def of_month(self, column: str = "allocation_month") -> str:
        return f"{column} = '{self.month}'" if self.month else f"{column} IS NOT NULL"


# --- rounding: half away from zero to four places, in whole numbers ---------


def _share(part: str, whole: str) -> str:
    return (
        f"CAST(sign({part}) * ((abs({part}) * 20000 + nullif({whole}, 0)) // (2 * nullif({whole}, 0)))"
        " AS DOUBLE) / 10000"
    )


def _big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


# --- building blocks --------------------------------------------------------


def _msg_data(w: Window) -> str:
    return f"""
SELECT created, company_id, type_of_comm, loan_id,
       CASE type_of_comm
         WHEN 'sms' THEN comm_dict ->> 'sms_language'
         WHEN 'whatsapp' THEN CASE
           WHEN t.name LIKE '%tamil%' THEN 'ta' WHEN t.name LIKE '%kannada%' THEN 'kn'
           WHEN t.name LIKE '%bengali%' THEN 'be' WHEN t.name LIKE '%telugunew%' THEN 'te'
           WHEN t.name IS NOT NULL THEN 'en' END
       END AS comm_language,
       nullif(comm_dict ->> 'delivered_time', '') AS delivery_status,
       nullif(comm_dict ->> 'opened_time', '') AS opened_status,
       CAST(comm_dict ->> 'sms_verification_link_clicked_count' AS BIGINT) AS click_count
FROM communication, LATERAL (SELECT lower(comm_dict ->> 'template_name') AS name) t
WHERE lower(type_of_comm) IN ('whatsapp', 'sms') AND {w.own()} AND {w.days('CAST(created AS DATE)')}
"""


def _ivr_data(w: Window) -> str:
    return f"""
SELECT loan_id, comm_dict ->> 'dtmf_ivr_mobile' AS mobile, comm_dict ->> 'start_time' AS start_time,
       comm_dict ->> 'end_time' AS end_time, comm_dict ->> 'call_duration' AS call_duration,
       comm_dict ->> 'template_name' AS template_name,
       comm_dict ->> '$.ivr_response.scenarioName' AS scenario_name,
       comm_dict ->> '$.error.groupName' AS error_nm,
       comm_dict ->> '$.ivr_response.collectedDtmfs' AS "collectedDtmfs",
       comm_dict ->> '$.ivr_response.collectedMappedDtmfs' AS "collectedMappedDtmfs",
       created, company_id, type_of_comm
FROM communication
WHERE lower(type_of_comm) = 'dtmf_ivr' AND allocation_month <> ''
  AND {w.own()} AND {w.days('CAST(created AS DATE)')}
"""


def _msg_agg() -> str:
    return """
SELECT loan_id, created, company_id, max(comm_language) AS comm_language,
       count(delivery_status) AS delivery_flag, count(opened_status) AS opened_flag,
       count(*) AS trigger_count, CAST(sum(click_count) AS BIGINT) AS click_count,
       lower(type_of_comm) AS type_of_comm
FROM msg_data GROUP BY ALL
"""


def _ivr_agg(w: Window) -> str:
    return f"""
SELECT loan_id, if(coalesce(secs, 0) > 0, 1, 0) AS call_pick, if(coalesce(secs, 0) >= 10, 1, 0) AS call_resp,
       if("collectedDtmfs" IS DISTINCT FROM '{{}}', 1, 0) AS end_of_message_rate,
       state AS ivr_resp_state,
       ['EOM not reached', 'Wrong input', 'responded yes', 'responded no'][state + 2] AS explicit_response,
       trigger_count, created, company_id, start_time, 'dtmf_ivr' AS type_of_comm,
       if(coalesce(lower(error_nm), 'user_errors') = 'user_errors', 0, 1) AS error_flag
FROM (
  SELECT *, TRY_CAST(call_duration AS INTEGER) AS secs,
         CASE WHEN "collectedMappedDtmfs" IN ('{{}}', '0') THEN -1
              WHEN "collectedMappedDtmfs" ILIKE '%yes%' THEN 1
              WHEN "collectedMappedDtmfs" ILIKE '%no%' THEN 2 ELSE 0 END AS state
  FROM (
    SELECT loan_id, created, start_time, company_id, type_of_comm, call_duration,
           "collectedMappedDtmfs", "collectedDtmfs", error_nm, count(type_of_comm) AS trigger_count
    FROM ivr_data WHERE {w.days('CAST(start_time AS DATE)')} GROUP BY ALL))
"""


_POPULATION = """
SELECT company_id, tag_name, allocation_month, count(loan_id) AS max_triggered
FROM tag_data GROUP BY ALL
"""

_CHANNEL_CLICKS = """
SELECT * FROM (
  SELECT company_id, loan_id, created,
         if(link_tag LIKE '%predue%_wa%', 'whatsapp', if(link_tag LIKE '%predue%_sms%', 'sms', NULL))
           AS type_of_comm
  FROM click_data)
WHERE type_of_comm IS NOT NULL
"""

_HOUR = {True: ", hours", False: ""}


def _msg_days(w: Window, combine: str, by_hour: bool) -> str:
    def f(column: str) -> str:
        return _big(f"{combine}({column})")

    return f"""
SELECT company_id, loan_id, type_of_comm, CAST(created AS DATE) AS date
       {', CAST(hour(created) AS INTEGER) AS hours' if by_hour else ''},
       {f('trigger_count')} AS triggered, {f('delivery_flag')} AS delivered, {f('opened_flag')} AS opened,
       CAST(0 AS BIGINT) AS responded, CAST(0 AS BIGINT) AS ended,
       {f('click_count')} AS clicked, {f('click_count')} AS explicit
FROM msg_agg WHERE {w.own()} AND {w.days('CAST(created AS DATE)')} GROUP BY ALL
"""


def _ivr_days(w: Window, combine: str, by_hour: bool) -> str:
    def f(column: str) -> str:
        return _big(f"{combine}({column})")

    hour = ", CAST(hour(CAST(start_time AS TIMESTAMP)) AS INTEGER) AS hours" if by_hour else ""
    return f"""
SELECT company_id, loan_id, type_of_comm, CAST(start_time AS DATE) AS date {hour},
       {f('trigger_count')} AS triggered,
       CAST({combine}(trigger_count) - sum(error_flag) AS BIGINT) AS delivered,
       {f('call_pick')} AS opened, {f('call_resp')} AS responded, {f('end_of_message_rate')} AS ended,
       CAST(0 AS BIGINT) AS clicked,
       {f('CAST(ivr_resp_state = 1 AS INTEGER)')} AS explicit
FROM ivr_agg WHERE {w.own()} AND {w.days('CAST(start_time AS DATE)')} GROUP BY ALL
"""


def _response(w: Window, days: str, by_hour: bool, clicks: bool) -> str:
    click_join = """
  LEFT JOIN channel_clicks c
    ON c.company_id = d.company_id AND c.loan_id = d.loan_id AND c.type_of_comm = d.type_of_comm
   AND month(c.created) = month(CAST(nullif(t.allocation_month, '') AS DATE))"""
    triggered = "trigger_count_sum"
    hours = _HOUR[by_hour]
    return f"""
SELECT company_id, allocation_month, date{hours}, tag_name, type_of_comm, loan_id_count,
       delivery_flag_sum, trigger_count_sum, opened_flag_sum,
       {_share('responded_sum', triggered)} AS response_percentage,
       {_share('ended_sum', triggered)} AS eom_percentage, click_flag_sum,
       {_share(triggered, 'max_triggered')} AS trigger_percentage,
       {_share('delivery_flag_sum', triggered)} AS delivery_percentage,
       {_share('opened_flag_sum', triggered)} AS react_percentage,
       {_share('explicit_sum', triggered)} AS explicit_response_percentage, max_triggered
FROM (
  SELECT d.company_id, t.allocation_month, d.date{hours}, t.tag_name, d.type_of_comm, p.max_triggered,
         count(d.loan_id) AS loan_id_count, {_big('sum(delivered)')} AS delivery_flag_sum,
         {_big('sum(triggered)')} AS trigger_count_sum, {_big('sum(opened)')} AS opened_flag_sum,
         {_big('sum(clicked)')} AS click_flag_sum, {_big('sum(responded)')} AS responded_sum,
         {_big('sum(ended)')} AS ended_sum, {_big('sum(explicit)')} AS explicit_sum
  FROM ({days}) d
  LEFT JOIN tag_data t ON t.company_id = d.company_id AND t.loan_id = d.loan_id
  {click_join if clicks else ''}
  LEFT JOIN population p ON p.company_id = d.company_id AND p.tag_name = t.tag_name
                        AND p.allocation_month = t.allocation_month
  GROUP BY ALL)
"""


def _overview(w: Window, table: str, bucket: str, delivered: str) -> str:
    return f"""
SELECT company_id, allocation_month, type_of_comm, date, tag_name, total_comms_triggered,
       total_comms_delivered,
       {_share('total_comms_delivered', 'total_comms_triggered')} AS delivery_percentage, loan_id_count
FROM (
  SELECT company_id, t.allocation_month, a.type_of_comm, CAST({bucket} AS DATE) AS date, t.tag_name,
         {_big('sum(trigger_count)')} AS total_comms_triggered,
         {_big(f'sum({delivered})')} AS total_comms_delivered, count(loan_id) AS loan_id_count
  FROM {table} a JOIN tag_data t USING (company_id, loan_id)
  WHERE {bucket} IS NOT NULL AND {w.days('CAST(a.created AS DATE)')} AND {w.own('a.company_id')}
  GROUP BY ALL)
"""


_SOURCES = {
    "communication": _COMMUNICATION,
    "tags": _TAGS,
    "click_data": _CLICK_DATA,
    "lending_default_details": _DEFAULTS,
    "lending_loan_details": _DETAILS,
}


def _with(w: Window, final: str, sources: dict[str, str], fresh: bool) -> str:
    """The final query under the tables a run of this window would have loaded.

    Reports read the tags of every month, as earlier runs have loaded them. In
    a ``fresh`` warehouse there are only those of the run's own month.
    """
    loaded = f"{w.own()} AND {w.of_month()}" if fresh else w.own()
    tables = {
        **sources,
        "msg_data": _msg_data(w),
        "ivr_data": _ivr_data(w),
        "tag_data": f"SELECT * FROM tags WHERE {loaded}",
        "msg_agg": _msg_agg(),
        "ivr_agg": _ivr_agg(w),
        "population": _POPULATION,
        "channel_clicks": _CHANNEL_CLICKS,
    }
    needed = _needed(final, tables)
    parts = [f"{n} AS ({tables[n]})" for n in tables if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final


def _needed(text: str, tables: dict[str, str]) -> set[str]:
    words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
    found: set[str] = set()
    for name in words & tables.keys():
        found |= {name} | _needed(tables[name], tables)
    return found


# --- the registered queries -------------------------------------------------


def _reports(w: Window) -> dict[str, str]:
    overview = (
        _overview(w, "msg_agg", "a.created", "delivery_flag"),
        _overview(w, "ivr_agg", "a.start_time", "call_pick"),
    )
    branches = {
        "channel_overview": overview,
        "channel_connectivity": (
            _response(w, _msg_days(w, "max", False), False, False),
            _response(w, _ivr_days(w, "max", False), False, False),
        ),
        "datewise_response": (
            _response(w, _msg_days(w, "sum", False), False, True),
            _response(w, _ivr_days(w, "sum", False), False, False),
        ),
        "hourwise_response": (
            _response(w, _msg_days(w, "sum", True), True, False),
            _response(w, _ivr_days(w, "sum", True), True, False),
        ),
    }
    result = {}
    for name, (message, ivr) in branches.items():
        result[name] = f"{message} UNION ALL BY NAME {ivr}"
        result[f"{name}_messages"] = message
        result[f"{name}_ivr"] = ivr
    return result


def _extracts(w: Window) -> dict[str, str]:
    allocation = f"""
SELECT a.* EXCLUDE (additional_variables), additional_variables ->> 'repayment_mode' AS repayment_mode,
       c.loan_details ->> 'mob' AS mob,
       c.loan_details ->> 'applicant_contact_number' AS applicant_contact_number
FROM lending_default_details a LEFT JOIN lending_loan_details c
  ON c.loan_id = a.loan_id AND c.company_id = a.company_id
WHERE {w.own('a.company_id')} AND {w.of_month()}
"""
    return {
        "message_facts": "SELECT * FROM msg_data",
        "ivr_facts": "SELECT * FROM ivr_data",
        "allocation": allocation,
        "loan_tags": f"SELECT * FROM tags WHERE {w.own()} AND {w.of_month()}",
        "message_loan_aggregate": "SELECT * FROM msg_agg",
        "ivr_loan_aggregate": "SELECT * FROM ivr_agg",
    }


def _parts(w: Window) -> dict[str, str]:
    counted = "company_id, loan_id, month(created) AS month_number"
    result = {
        "tag_population": "SELECT * FROM population",
        "tag_copies": """
SELECT company_id, loan_id, tag_name, allocation_month, count(*) AS tag_rows
FROM tag_data WHERE loan_id IS NOT NULL GROUP BY ALL""",
        "channel_clicks": "SELECT * FROM channel_clicks",
        "monthly_clicks": f"""
SELECT {counted}, count(*) FILTER (WHERE type_of_comm = 'whatsapp') AS whatsapp_clicks,
       count(*) FILTER (WHERE type_of_comm = 'sms') AS sms_clicks
FROM channel_clicks GROUP BY ALL""",
        "rejected_durations": """
SELECT count(*) AS rejected_rows FROM ivr_data
WHERE start_time IS NOT NULL AND call_duration IS NOT NULL
  AND NOT regexp_full_match(call_duration, '[+-]?[0-9]+')""",
    }
    for name, combine, by_hour in (
        ("loan_day_max", "max", False),
        ("loan_day_sum", "sum", False),
        ("loan_hour_sum", "sum", True),
    ):
        result[f"message_{name}"] = f"SELECT * FROM ({_msg_days(w, combine, by_hour)})"
        result[f"ivr_{name}"] = f"SELECT * FROM ({_ivr_days(w, combine, by_hour)})"
    return result


# The columns of a run's tables, for digests of their rows.
_RESPONSE = (
    "company_id allocation_month date tag_name type_of_comm loan_id_count delivery_flag_sum trigger_count_sum "
    "opened_flag_sum response_percentage eom_percentage click_flag_sum trigger_percentage delivery_percentage "
    "react_percentage explicit_response_percentage max_triggered"
)
_COLUMNS = {
    "allocation_data": "company_id loan_id default_id allocation_month amount_recovered_breakdown repayment_mode "
    "mob applicant_contact_number",
    "tag_data": "company_id loan_id tag_name allocation_month",
    "ivr_data": "loan_id mobile start_time end_time call_duration template_name scenario_name error_nm "
    "collectedDtmfs collectedMappedDtmfs created company_id type_of_comm",
    "msg_data": "created company_id type_of_comm loan_id comm_language delivery_status opened_status click_count",
    "msg_agg_data": "loan_id created company_id comm_language delivery_flag opened_flag trigger_count click_count "
    "type_of_comm",
    "ivr_agg_data": "loan_id call_pick call_resp end_of_message_rate ivr_resp_state explicit_response trigger_count "
    "created company_id start_time type_of_comm error_flag",
    "channel_agg_overview": "company_id allocation_month type_of_comm date tag_name total_comms_triggered "
    "total_comms_delivered delivery_percentage loan_id_count",
    "channel_connectivity_response": _RESPONSE,
    "datewise_channel_response": _RESPONSE,
    "hourwise_channel_response": f"{_RESPONSE} hours",
}


def _digest(table: str, times: int = 1) -> str:
    """The sum of 48 bits of each row's values as text, columns by name; shares with six decimals."""
    shares = "CAST(CAST({0} AS DECIMAL(20, 6)) AS VARCHAR)"
    texts = [
        f"coalesce({(shares if c.endswith('_percentage') else 'CAST({0} AS VARCHAR)').format(chr(34) + c + chr(34))}, '~')"
        for c in sorted(_COLUMNS[table].split())
    ]
    bits = f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(texts)})), 1, 12) AS BIGINT)"
    return _big(f"sum({bits}) * {times} % {1 << 62}")


def _full_run(w: Window) -> str:
    names = {
        "allocation_data": "allocation",
        "tag_data": "loan_tags",
        "ivr_data": "ivr_facts",
        "msg_data": "message_facts",
        "msg_agg_data": "message_loan_aggregate",
        "ivr_agg_data": "ivr_loan_aggregate",
        "channel_agg_overview": "channel_overview",
        "channel_connectivity_response": "channel_connectivity",
        "datewise_channel_response": "datewise_response",
        "hourwise_channel_response": "hourwise_response",
    }
    texts = {**_extracts(w), **_reports(w)}
    sums = {
        "channel_agg_overview": "total_comms_triggered",
        "channel_connectivity_response": "trigger_count_sum",
        "datewise_channel_response": "trigger_count_sum",
        "hourwise_channel_response": "trigger_count_sum",
        "msg_agg_data": "trigger_count",
        "ivr_agg_data": "trigger_count",
    }
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS table_rows, "
        f"{_big(f'sum({sums[table]})') if table in sums else 'CAST(NULL AS BIGINT)'} AS triggered, "
        f"{_digest(table)} AS digest "
        f"FROM ({texts[query]})"
        for table, query in names.items()
    )


def _appended() -> str:
    texts = _extracts(ALL)
    names = {"allocation_data": "allocation", "tag_data": "loan_tags", "ivr_data": "ivr_facts", "msg_data": "message_facts"}
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, 2 * count(*) AS table_rows, CAST(NULL AS BIGINT) AS triggered, "
        f"{_digest(table, 2)} AS digest FROM ({texts[query]})"
        for table, query in names.items()
    )


ALL = Window()
ONE_RUN = Window("co-1", "2024-01-03", "2024-01-20", "2024-1-01")


def oracle_sql(sources_exist: bool = False) -> dict[str, str]:
    """The SQL of each query. With ``sources_exist``, the source tables are read as views."""
    result = {**_extracts(ALL), **_reports(ALL), **_parts(ALL), "full_run": _full_run(ALL), "appended_extracts": _appended()}
    one_run = {**_extracts(ONE_RUN), **_reports(ONE_RUN), "full_run": _full_run(ONE_RUN)}
    result.update({f"{name}_one_run": text for name, text in one_run.items() if not _is_branch(name)})
    windows = {name: (ONE_RUN if name.endswith("_one_run") else ALL) for name in result}
    sources = {} if sources_exist else _SOURCES
    return {
        name: _with(windows[name], text, sources, name.startswith("full_run"))
        for name, text in result.items()
    }


def _is_branch(name: str) -> bool:
    return name.endswith(("_messages", "_ivr"))
