"""SQL twins (DuckDB) of the registered training-data queries that SQL can express."""

from __future__ import annotations

from clickloom.llm.quality import BOILERPLATE, LineRules

MARKS = "'" + LineRules().end_marks.replace("'", "''") + "'"

ORACLES: dict[str, str] = {}

ORACLES["op7_mixing"] = r"""
with d as (
  select doc_id, source, md5('mix:' || coalesce(cast(doc_id as varchar), '')) as key,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (
  select source, source_size, 3 * source_size as bound,
    [5, 2, 1][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as bigint)] as weight
  from s),
l as (
  select *, cast((sum(source_size) over () - coalesce(sum(bound) over (o rows between unbounded preceding and 1 preceding), 0)) as double)
    / cast(sum(weight) over (o rows between current row and unbounded following) as double) as level
  from w window o as (order by bound / weight, source nulls last)),
t as (
  select source, source_size, least(cast(bound as double), max(level) over () * weight) as target from l),
p as (
  select d.*, coalesce(sum(size) over (partition by source order by key, doc_id rows between unbounded preceding and 1 preceding), 0) as before
  from d),
b as (
  select p.*, source_size, target, cast(floor(target + 0.5) as bigint) as budget
  from p join t on p.source is not distinct from t.source)
select doc_id, size, source_size, target,
  cast(coalesce(budget // nullif(source_size, 0), 0) * size
    + greatest(0, least(size, budget - coalesce(budget // nullif(source_size, 0), 0) * source_size - before)) as bigint) as taken
from b
"""

ORACLES["op5_quality_rules"] = rf"""
with d as (
  select doc_id, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
x as (
  select doc_id, unnest(range(1, len(w) - 1)) as i, w from d where len(w) >= 3),
g as (
  select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as c from x),
r as (
  select doc_id, count(distinct k) as n from (
    select doc_id, unnest([i, i + 1, i + 2]) as k from g where c > 1) group by doc_id),
c as (
  select doc_id, line, min(j) from (select doc_id, unnest(lines) as line, unnest(range(1, len(lines) + 1)) as j from d)
  group by doc_id, line),
k as (
  select doc_id, sum(length(line) + 1) - 1 as n_clean from c
  where contains({MARKS}, right(rtrim(line, ' '), 1))
    and 100 * len(regexp_extract_all(line, '[#*$%&|<>]')) <= 7 * length(line)
    and 100 * len(regexp_extract_all(line, '\p{{Lu}}')) <= 50 * length(line)
    and not regexp_matches(lower(line), '{"|".join(BOILERPLATE)}')
  group by doc_id),
m as (
  select d.doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(r.n, 0) as bigint) as n_repeat_words, coalesce(n_clean, 0) as n_clean, length(t) as n_text
  from d left join r using (doc_id) left join k using (doc_id)),
f as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and 100 * n_clean >= 60 * n_text as kept
from f
"""

ORACLES["op13_filter_audit"] = r"""
with d as (
  select doc_id, coalesce(cast(source as varchar), '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
l as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels group by doc_id),
f as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    case when len(w) < 200 then 1 else 0 end
    + case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end
    + case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) then 4 else 0 end
    + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
    + case when d.doc_id > min(d.doc_id) over (partition by t) then 16 else 0 end as mask
  from d left join l on d.doc_id = l.doc_id),
g as (
  select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by part, mask),
b as (
  select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as x(name, bit)),
p as (
  select [b1.name, b2.name, b3.name, b4.name, b5.name] as names, [b1.bit, b2.bit, b3.bit, b4.bit, b5.bit] as bits
  from b b1, b b2, b b3, b b4, b b5
  where b1.bit | b2.bit | b3.bit | b4.bit | b5.bit = 31),
s as (
  select array_to_string(names, '') as filter_order, step, names[step] as name, bits[step] as own,
    cast(coalesce(list_sum(bits[1:step - 1]), 0) as integer) as earlier
  from p, (select unnest([1, 2, 3, 4, 5]) as step)),
r as (
  select part, filter_order, cast(step as integer) as step, name,
    sum(case when mask & (earlier | own) = 0 then n else 0 end) as kept,
    sum(case when mask & earlier = 0 and mask & own <> 0 then n else 0 end) as removed,
    sum(case when mask & earlier <> 0 and mask & own <> 0 then n else 0 end) as redundant,
    sum(case when mask = own then n else 0 end) as unique_fails,
    sum(case when mask & earlier = 0 and mask & own <> 0 then good else 0 end) as good_lost,
    sum(case when mask & earlier = 0 and mask & own <> 0 then toxic else 0 end) as toxic_lost
  from s, g group by part, filter_order, step, name)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, name) as bigint) as shapley
from r
"""
