"""DuckDB SQL for the operators whose results SQL can express."""

from __future__ import annotations

#: The codebooks of vectors cut in 4 parts, learned in 4 rounds.
_CODES_START = """
with kept as materialized (
  select vec_id, label, list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as whole
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), cells as materialized (
  select vec_id, (i - 1) // (len(whole) // 4) as part, (i - 1) % (len(whole) // 4) as pos, whole[i] as x
  from kept, lateral (select unnest(range(1, len(whole) + 1)) as i)
), book0 as materialized (
  select entry, part, pos, x as y
  from cells join (
    select vec_id, row_number() over (order by vec_id) - 1 as entry from kept qualify entry < 256
  ) using (vec_id)
)"""
_CODES_NEAR = """, near{r} as materialized (
  select vec_id, part, min(square * 256 + entry) % 256 as entry, min(square * 256 + entry) // 256 as square
  from (
    select vec_id, part, entry, sum((x - y) * (x - y))::bigint as square
    from cells join book{r} using (part, pos) group by vec_id, part, entry
  ) group by vec_id, part
)"""
_CODES_BOOK = """, mean{n} as (
  select part, entry, pos, sum(x)::bigint as s, count(*) as c
  from cells join near{r} using (vec_id, part) group by part, entry, pos
), book{n} as materialized (
  select entry, part, pos, coalesce((s - ((s % c) + c) % c) // c, y) as y
  from book{r} left join mean{n} using (entry, part, pos)
)"""
_CODES_END = """, coded as (
  select vec_id, string_agg(printf('%02x', entry), '' order by part) as code, sum(square)::bigint as error
  from near4 group by vec_id
), digest as (
  select sha256(string_agg(y::varchar, ',' order by part, entry, pos)) as codebooks_sha256 from book4
)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from coded join kept using (vec_id), digest
"""
_CODES = _CODES_START + "".join(_CODES_NEAR.format(r=r) + _CODES_BOOK.format(r=r, n=r + 1) for r in range(4)) + _CODES_NEAR.format(r=4) + _CODES_END

_FILL_IN_MIDDLE = """
with drawn as (
  select doc_id, coalesce("text", '') as t, length(coalesce("text", '')) as n, sha256('1:' || doc_id::varchar) as h
  from documents
), cut as (
  select doc_id, t, n,
    least(('0x' || h[1:8])::ubigint % (n + 1), ('0x' || h[9:16])::ubigint % (n + 1))::bigint as one,
    greatest(('0x' || h[1:8])::ubigint % (n + 1), ('0x' || h[9:16])::ubigint % (n + 1))::bigint as two,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
        or ('0x' || h[17:24])::ubigint % 100 >= 90 then 'plain'
      when ('0x' || h[25:32])::ubigint % 100 < 20 then 'spm' else 'psm' end as form
  from drawn
), parts as (
  select *, substring(t, 1, one) as prefix, substring(t, one + 1, two - one) as middle, substring(t, two + 1) as suffix
  from cut
)
select doc_id, n, form,
  case when form <> 'plain' then one end as prefix_chars,
  case when form <> 'plain' then two - one end as middle_chars,
  sha256(case form when 'plain' then t
    when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(t) as restored_sha256
from parts
"""

_WARC = """
with payloads as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digest from pages
), largest as (
  select payload, max(page_id) as response from payloads group by payload
)
select page_id, octet_length(encode(payload))::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(digest, 10 * (i // 8)::int + 1, 10))::ubigint >> (35 - 5 * (i % 8))::ubigint) & 31)::int + 1, 1)), '') as payload_digest,
  case when page_id = response then 'response' else 'revisit' end as record_type,
  case when page_id <> response then response end as refers_to
from payloads join largest using (payload)
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_vector_codes": _CODES, "op12_fill_in_middle": _FILL_IN_MIDDLE, "op13_warc": _WARC}
