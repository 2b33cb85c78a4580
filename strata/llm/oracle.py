"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

# Sizes in words, the water level of the targets (a source is full when 3 * size / weight is
# among the smallest), and the rows below each source's budget in the order of their hash.
OP1 = r"""
with d as (
  select doc_id, coalesce(source, '') as src, source is null as no_source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5(concat_ws(':', doc_id::varchar, text)), 1, 15))::bigint as key
  from documents),
s as (select src, no_source, sum(size)::bigint as source_size from d group by all),
w as (select *, [5.0, 2.0, 1.0][(row_number() over (order by no_source, src) - 1) % 3 + 1]::double as weight from s),
o as (select *, row_number() over (order by 3.0 * source_size / weight, no_source, src) as i from w),
c as (select *, sum(source_size) over () as total,
             coalesce(sum(3.0 * source_size) over (order by i rows between unbounded preceding and 1 preceding), 0) as full_before,
             sum(weight) over (order by i rows between current row and unbounded following) as weight_left from o),
f as (select min((total - full_before) / weight_left) filter (where (total - full_before) / weight_left * weight < 3.0 * source_size) as factor,
             min(i) filter (where (total - full_before) / weight_left * weight < 3.0 * source_size) as first_open from c),
t as (select src, no_source, source_size,
             case when source_size = 0 then 0.0 when i < first_open then 3.0 * source_size
                  else (select (total - full_before) / weight_left from c x where x.i = f.first_open) * weight end as target
      from c, f),
p as (select *, floor(target / greatest(source_size, 1)) as passes from t),
r as (select *, target - passes * source_size as budget from p),
k as (select src, no_source, key, sum(size) as size from d group by all),
e as (select *, sum(size) over (partition by src, no_source order by key) as upto from k),
x as (select d.doc_id, d.size, r.source_size, r.target,
             (d.size * (r.passes + case when 2 * (e.upto - e.size) + e.size <= 2 * r.budget then 1 else 0 end))::bigint as taken
      from d join r using (src, no_source) join e using (src, no_source, key))
select doc_id, size, source_size, target, taken from x
"""

OP6 = """
with p as (select page_id, coalesce(html, '') as html, strlen(coalesce(html, ''))::bigint as payload_bytes,
                  sha1(coalesce(html, '')) as payload_digest from pages),
m as (select *, max(page_id) over (partition by payload_digest) as held_by from p)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id < held_by then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id < held_by then held_by end as refers_to
from m
"""

# Turns as calls and results; the record is put together from the JSON of its fields, null ones left out.
OP2 = r"""
with t as (select *, coalesce(text, '') as body from conversations where conv_id is not null and turn is not null),
c as (select conv_id, turn, role, 'call_' || turn as call_id, body,
             coalesce(len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')), 0)::bigint as words,
             case when role = 'user' and turn > 0 then 'call_' || greatest(turn - 2, 0) end as need
      from t where role in ('system', 'user')),
f as (select conv_id, call_id, min(turn) as first_turn from c group by 1, 2),
r as (select conv_id, 'call_' || (turn - 1) as call_id, min({turn: turn, text: text}) as x, count(*) as n_results
      from t where role = 'assistant' group by 1, 2),
p as (select c.*, f.first_turn, coalesce(r.n_results, 0) as n_results, r.x.text as result, n.call_id is null and need is not null as need_missing,
             concat_ws(',', case when body = '' then 'text:minLength' end, case when role = 'user' and turn < 0 then 'turn:minimum' end,
                       case when role = 'user' and words < 1 then 'words:minimum' end, case when role = 'user' and words > 400 then 'words:maximum' end) as problems
      from c join f using (conv_id, call_id) left join r using (conv_id, call_id) left join f n on n.conv_id = c.conv_id and n.call_id = c.need),
s as (select *, case when turn > first_turn then 'duplicate_id' when problems <> '' then 'invalid' when need_missing then 'missing_need'
                     when n_results = 0 then 'unanswered' else 'ok' end as status from p),
j as (select conv_id, call_id, turn, case role when 'system' then 'configure' else 'reply' end as name, status, first_turn as topo, n_results, problems,
             '{"arguments":{"text":' || to_json(body) || case role when 'user' then ',"turn":' || turn || ',"words":' || words else '' end || '}' as args, need, result from s)
select conv_id, call_id, turn, name, status, topo, n_results, problems,
       args || ',"call_id":' || to_json(call_id) || ',"name":' || to_json(name) || ',"needs":[' || coalesce(to_json(need)::varchar, '') || '],"order":' || topo
            || case when result is not null then ',"result":' || to_json(result) else '' end || ',"status":' || to_json(status) || '}' as record
from j
union all
select r.conv_id, r.call_id, r.x.turn, null, 'orphan_result', null, r.n_results, null,
       '{"call_id":' || to_json(r.call_id) || ',"needs":[]' || case when r.x.text is not null then ',"result":' || to_json(r.x.text) else '' end || ',"status":"orphan_result"}'
from r left join f using (conv_id, call_id) where f.call_id is null
"""

# Rows by part and set of failed filters, every order of the five filters step by step.
OP12 = r"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words, min(doc_id) over (partition by t) as first_id from d),
m as (select doc_id, part, (len(words) < 100)::int + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::int
        + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t))::int + 8 * regexp_matches(t, '[#$%&*|]')::int
        + 16 * coalesce(doc_id > first_id, false)::int as mask from w),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by 1),
c as (select part, mask, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic from m left join l using (doc_id) group by 1, 2),
f as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(name, bit)),
o as (select a.name || b.name || c.name || d.name || e.name as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
      from f a, f b, f c, f d, f e where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s as (select filter_order, step, coalesce(list_sum(bits[1:step - 1]), 0)::int as before, bits[step] as bit from o, range(1, 6) r(step)),
x as (select part, filter_order, step::int as step, bit,
        sum(case when mask & (before | bit) = 0 then n else 0 end)::bigint as kept,
        sum(case when mask & before = 0 and mask & bit > 0 then n else 0 end)::bigint as removed,
        sum(case when mask & before > 0 and mask & bit > 0 then n else 0 end)::bigint as redundant,
        sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
        sum(case when mask & before = 0 and mask & bit > 0 then good else 0 end)::bigint as good_lost,
        sum(case when mask & before = 0 and mask & bit > 0 then toxic else 0 end)::bigint as toxic_lost
      from c, s group by 1, 2, 3, 4, before)
select * exclude (bit), (sum(removed) over (partition by part, bit))::bigint as shapley from x
"""

ORACLE_SQL: dict[str, str] = {"op1_mixing": OP1, "op2_chat_tools": OP2, "op6_warc": OP6, "op12_filter_audit": OP12}
