"""Source tables as FIXTURES.md section 2 defines them, for its expected counts."""

from __future__ import annotations

# The SQL of FIXTURES.md, section 2.
SQL = {
    "communication": r"""
SELECT event_id,
 concat('co-', cast(user_id % 3 as string)) AS company_id,
 concat('L', cast(user_id as string)) AS loan_id,
 CASE WHEN event_type IN ('click','signup') THEN CASE WHEN event_id % 11 = 0 THEN 'WhatsApp' ELSE 'whatsapp' END
      WHEN event_type = 'view' THEN CASE WHEN event_id % 11 = 0 THEN 'SMS' ELSE 'sms' END
      ELSE 'dtmf_ivr' END AS type_of_comm,
 cast(concat(cast(cast(ts as date) as string),' ',lpad(cast(hour(ts) - hour(ts) % 6 as string),2,'0'),':00:00') as TIMESTAMP_NTZ) AS created,
 CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 19 = 0 THEN NULL ELSE '2024-1-01' END AS allocation_month,
 concat('{"sms_language":"', CASE WHEN event_id % 2 = 0 THEN 'en' ELSE 'hi' END,
  '","template_name":"', CASE (event_id * 7 + user_id) % 6 WHEN 0 THEN 'due_Tamil_v1' WHEN 1 THEN 'due_KANNADA' WHEN 2 THEN 'due_bengali' WHEN 3 THEN 'due_telugunew' WHEN 4 THEN 'due_telugu' ELSE 'due_english' END,
  '","delivered_time":"', CASE WHEN event_id % 5 = 0 THEN '' ELSE concat(cast(cast(ts as date) as string),' 10:00:00') END,
  '","opened_time":', CASE WHEN event_id % 3 = 0 THEN 'null' ELSE '"x"' END,
  ',"sms_verification_link_clicked_count":', CASE WHEN event_id % 4 = 0 THEN 'null' ELSE cast(event_id % 4 as string) END,
  ',"start_time":', CASE WHEN event_id % 13 = 0 THEN 'null' ELSE concat('"',cast(cast(ts as date) as string),' ',lpad(cast(hour(ts) as string),2,'0'),':15:00"') END,
  ',"call_duration":"', cast(event_id % 25 as string),
  '","ivr_response":{"scenarioName":"s1","collectedDtmfs":', CASE WHEN event_id % 6 = 0 THEN '{}' WHEN event_id % 6 = 1 THEN 'null' ELSE '{"1":"1"}' END,
  ',"collectedMappedDtmfs":', CASE event_id % 7 WHEN 0 THEN '{}' WHEN 1 THEN '"0"' WHEN 2 THEN '{"1":"Yes"}' WHEN 3 THEN '{"1":"NO"}' WHEN 4 THEN '{"1":"9"}' WHEN 5 THEN 'null' ELSE '{"1":"no then yes"}' END,
  '},"error":{"groupName":', CASE event_id % 9 WHEN 0 THEN '"SYSTEM"' WHEN 1 THEN '"USER_ERRORS"' ELSE 'null' END, '}}') AS comm_dict
FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 23 = 0) e
""",
    "tags": r"""
SELECT DISTINCT concat('co-', cast(u.user_id % 3 as string)) AS company_id, concat('L', cast(u.user_id as string)) AS loan_id,
 CASE WHEN m.k = 0 THEN c.c_mktsegment ELSE 'RETARGET' END AS tag_name,
 CASE WHEN m.k = 2 THEN '2024-2-01' ELSE '2024-1-01' END AS allocation_month
FROM (SELECT DISTINCT user_id FROM events) u JOIN customer c ON c.c_custkey = u.user_id
 JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) m ON m.k = 0 OR (m.k = 1 AND u.user_id % 4 = 0) OR (m.k = 2 AND u.user_id % 5 = 0)
WHERE u.user_id % 7 <> 0
""",
    "click_data": r"""
SELECT concat('co-', cast(user_id % 3 as string)) AS company_id, concat('L', cast(user_id as string)) AS loan_id, ts AS created,
 CASE event_id % 4 WHEN 0 THEN 'x_predue_1_wa_a' WHEN 1 THEN 'predue_sms' WHEN 2 THEN 'predue_z_sms_b' ELSE 'postdue_wa' END AS link_tag
FROM events WHERE event_type = 'click' AND event_id % 5 = 0
""",
    "lending_default_details": r"""
SELECT concat('co-', cast(o_custkey % 3 as string)) AS company_id, concat('L', cast(o_custkey as string)) AS loan_id, o_orderkey AS default_id,
 CASE WHEN o_orderkey % 3 = 0 THEN '2024-2-01' ELSE '2024-1-01' END AS allocation_month,
 concat('{"repayment_mode":', CASE WHEN o_orderkey % 4 = 0 THEN 'null' ELSE concat('"', lower(o_orderstatus), '"') END, '}') AS additional_variables,
 concat('{"principal":', cast(o_orderkey % 100 as string), '}') AS amount_recovered_breakdown FROM orders
""",
    "lending_loan_details": r"""
SELECT concat('co-', cast(c_custkey % 3 as string)) AS company_id, concat('L', cast(c_custkey as string)) AS loan_id,
 concat('{"mob":"', cast(c_custkey % 24 as string), '","applicant_contact_number":', CASE WHEN c_custkey % 6 = 0 THEN 'null' ELSE concat('"9', lpad(cast(c_custkey as string), 9, '0'), '"') END, '}') AS loan_details
FROM customer WHERE c_custkey % 8 <> 0
""",
}


def tables(spark, sf_dir):
    for name in ("events", "customer", "orders"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    return {name: spark.sql(text) for name, text in SQL.items()}
