"""SQL for the spans of personal data, in plain expressions: what the patterns must find.

Its expressions have no look-around; the signs before and after an added span are
tested instead.
"""


def _base_sql(kind: str, pattern: str) -> str:
    """Spans of a base kind: matches, placed by the pieces of text between them."""
    return f"""
select doc_id, '{kind}' as kind, k, m,
  (list_sum(list_transform(g[1:k], lambda x: length(x)))
   + coalesce(list_sum(list_transform(a[1:k - 1], lambda x: length(x))), 0))::bigint as s
from (select doc_id, a, g, unnest(a) as m, unnest(range(1, len(a) + 1)) as k from (
  select doc_id, regexp_extract_all(text, '{pattern}') as a,
    regexp_split_to_array(text, '{pattern}') as g from whole) where len(a) > 0)"""


SQL_PII = (
    "with whole as (select doc_id, coalesce(text, '') as text from documents), found as ("
    + " union all ".join(
        _base_sql(kind, pattern)
        for kind, pattern in (
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"),
            ("card", r"[0-9](?:[ -]?[0-9])+"),
            ("phone", r"\+[0-9][ ().0-9-]+[0-9]"),
            ("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?"),
            ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
        )
    )
    + r"""), measured as (
select f.*, regexp_replace(m, '[^0-9]', '', 'g') as d, replace(m, ' ', '') as b,
  substr(w.text, s, 1) as ahead, substr(w.text, s + length(m) + 1, 1) as behind,
  lower(substr(w.text, greatest(s - 48, 0) + 1, s - greatest(s - 48, 0))) as context
from found f join whole w on f.doc_id = w.doc_id
), good as (
select * from measured where case kind when 'email' then true
  when 'ip' then list_max(list_transform(string_split(m, '.'), lambda x: x::hugeint)) <= 255
  when 'phone' then length(d) between 9 and 15
  when 'ssn' then not regexp_matches(ahead || behind, '[0-9-]') and not regexp_matches(m, '^(000|666|9)|-00-|-0000$')
    and regexp_matches(context, 'ssn|social.security')
    and not regexp_matches(context, 'example|sample|version|isbn|order no|invoice')
  when 'iban' then not regexp_matches(ahead || behind, '[A-Za-z0-9]') and length(b) between 15 and 34
    and list_reduce(list_transform(string_split(b[5:] || b[1:4], ''), lambda c: ascii(c)::bigint),
      lambda r, c: case when c < 58 then (r * 10 + c - 48) % 97 else (r * 100 + c - 55) % 97 end, 0::bigint) = 1
  else length(d) between 13 and 19 and list_sum(list_transform(range(1, length(d) + 1),
    lambda i: case when i % 2 = 1 then reverse(d)[i]::int
      when reverse(d)[i]::int > 4 then reverse(d)[i]::int * 2 - 9 else reverse(d)[i]::int * 2 end)) % 10 = 0 end
)
select w.doc_id,
  count(*) filter (kind = 'email') as n_email, count(*) filter (kind = 'ip') as n_ip,
  count(*) filter (kind = 'card') as n_card, count(*) filter (kind = 'phone') as n_phone,
  sha256(coalesce(string_agg(span, ',' order by place, s) filter (place < 5), '')) as base_sha256,
  coalesce(string_agg(span, ',' order by place, s), '') as spans
from whole w left join (
  select *, kind || ':' || s || ':' || (s + length(m)) as span,
    list_position(['email', 'ip', 'card', 'phone', 'iban', 'ssn'], kind) as place from good) g on w.doc_id = g.doc_id
group by w.doc_id"""
)
