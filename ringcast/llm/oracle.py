"""DuckDB SQL that gives the rows of the registered queries another way."""

from __future__ import annotations

from ringcast.llm import quality_rules as rules

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

_stock = " or ".join(
    "contains(lower(line), '{}')".format(p.replace("'", "''")) for p in rules.PHRASES
)
_closing = "".join("\\" + c if c in ")]}" else c for c in rules.CLOSING).replace("'", "''")

QUALITY_RULES = rf"""
with d as (
  select doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') as w
  from documents
),
runs as (
  select doc_id, i, count(*) over (partition by doc_id, run) as times
  from (select doc_id, unnest(range(1, len(w) - 3)) as i, w from d) s,
       lateral (select array_to_string(w[i:i + 4], ' ') as run) r
),
repeated as (
  select doc_id, count(distinct word) as n
  from (select doc_id, unnest(range(i, i + 5)) as word from runs where times > 1)
  group by doc_id
),
line as (
  select doc_id, unnest(string_split(text, chr(10))) as line,
         unnest(range(len(string_split(text, chr(10))))) as nr
  from d
),
filled as (
  select *, row_number() over (partition by doc_id, line order by nr) > 1 as earlier,
    length(regexp_replace(line, '{SPACE}', '', 'g')) as chars,
    len(regexp_extract_all(line, '{WORD}')) as words,
    len(regexp_extract_all(line, '[{rules.SEPARATORS}]')) as separators,
    len(regexp_extract_all(line, '[#*$%&<>]')) as symbols,
    length(line) - length(replace(line, '!', '')) as bangs
  from line
  where regexp_matches(line, '{WORD}')
),
marked as (
  select *, words <= {rules.MENU_WORDS}
    and not regexp_matches(line, '[{_closing}]{SPACE[:-1]}*$') as bare
  from filled
),
placed as (
  select *, row_number() over (partition by doc_id order by nr)
    - row_number() over (partition by doc_id, bare order by nr) as island
  from marked
),
judged as (
  select *, 10 * symbols > chars or 10 * bangs > chars
    or (separators >= 2 and 4 * separators >= words)
    or (bare and count(*) over (partition by doc_id, bare, island) >= {rules.MENU_LINES})
    or earlier or {_stock} as failed
  from placed
),
lines as (
  select doc_id, count(*) as n, count(*) filter (where failed) as n_failed,
    count(*) filter (where earlier) as n_dup, sum(chars) filter (where failed) as lost
  from judged group by doc_id
),
counts as (
  select d.doc_id, len(w) as n_words,
    length(regexp_replace(text, '{SPACE}', '', 'g')) as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
    coalesce(n_dup, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words,
    coalesce(l.n, 0) as n_lines, coalesce(n_failed, 0) as n_failed_lines,
    coalesce(lost, 0)::bigint as lost_chars
  from d left join lines l using (doc_id) left join repeated r using (doc_id)
),
based as (
  select *, n_words < {rules.MIN_WORDS}
    or 100 * n_repeat_words > {rules.REPEAT_PERCENT} * n_words as base_failed
  from counts
)
select *, not base_failed and lost_chars <= {rules.MAX_LOST}::double * word_chars as kept
from based
"""

MIXING = rf"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size
  from documents
),
s as (
  select source, sum(size)::bigint as source_size, 2 * sum(size)::bigint as most,
    [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
  from d group by source
),
leveled as (
  select *,
    (1.5::double * sum(source_size) over ()
      - coalesce(sum(most) over (o rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (o rows between current row and unbounded following) as level
  from s window o as (order by most / weight, source nulls last)
),
target as (
  select source, source_size,
    round(least(most::double,
      weight * (select max(level) from leveled where most >= weight * level)), 6) as target
  from leveled
),
t as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole,
    target - (case when source_size > 0 then floor(target / source_size) else 0 end)
      * source_size as remaining
  from target
),
lengths as (
  select source, size, count(*) as n from d where size > 0 group by source, size
),
scales as (
  select source, max_by(scale, size) as scale
  from (
    select l.source, size,
      (remaining - coalesce(sum(size * n)
          over (o rows between unbounded preceding and 1 preceding), 0))
      / sum(size::hugeint * size * n)
          over (o rows between current row and unbounded following)::double as scale
    from lengths l join t on l.source is not distinct from t.source
    window o as (partition by l.source order by size desc)
  )
  where scale * size <= 1 group by source
),
drawn as (
  select d.*, t.* exclude (source), coalesce(scale, 0) * size as p,
    (('0x' || substr(md5(concat_ws(':', doc_id, row_number()
        over (partition by doc_id, d.source, size))), 1, 13))::bigint + 0.5)
      / 4503599627370496.0::double as u
  from d join t on d.source is not distinct from t.source
    left join scales s on d.source is not distinct from s.source
),
ranked as (
  select *, case when p >= 1 then 0.0
    else (u / (1 - u)) / (p / (1 - p)) end as rank
  from drawn where size > 0 and p > 0
),
summed as (
  select *, sum(size) over (partition by source order by rank, doc_id, size
    rows between unbounded preceding and current row) as to_here
  from ranked
),
taken as (
  select doc_id, source, size, source_size, target, whole,
    to_here - size / 2 <= remaining as extra from summed
  union all
  select doc_id, source, size, source_size, target, whole, false
  from drawn where not (size > 0 and p > 0)
)
select doc_id, source, size, source_size, target,
  (whole + extra::int)::bigint as copies, ((whole + extra::int) * size)::bigint as taken
from taken
"""

WARC = """
with p as (
  select page_id, coalesce(html, '') as payload, sha256(coalesce(html, '')) as digest,
    octet_length(encode(coalesce(html, '')))::bigint as n
  from pages
),
f as (select digest, min(page_id) as first from p where n >= 100 group by digest)
select page_id, n as payload_bytes, p.digest as payload_digest,
  case when first is not null and page_id is distinct from first
    then 'revisit' else 'response' end as record_type,
  case when page_id is distinct from first then first end as refers_to
from p left join f on p.digest = f.digest
"""

ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all({_low}, '{ITEM_WORD}') as w
  from documents
),
b as (select item_id, regexp_extract_all({_low}, '{ITEM_WORD}') as w from benchmark),
win as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + 9], ' ') as run
  from (select *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)
),
found as (
  select r, i, n, run
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i
        from d, (select distinct n from win) where len(w) >= n) s,
       lateral (select array_to_string(w[i:i + n - 1], ' ') as run) t
),
hits as (
  select r, i, h.n, item_id from found h join win on win.run = h.run and win.n = h.n
),
words as (
  select r, count(distinct pos) as n_hit
  from (select r, unnest(range(i, i + n)) as pos from (select distinct r, i, n from hits))
  group by r
),
items as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct r, item_id::varchar as item from hits where item_id is not null)
  group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join items using (r)
"""

_bits = " + ".join(f"{1 << i} * {c}::int" for i, c in enumerate("abcde"))

FILTER_AUDIT = rf"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') as w
  from documents
),
l as (
  select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic
  from labels group by doc_id
),
failed as (
  select doc_id, part,
    len(w) < 50 as a,
    100 * len(list_distinct(w)) < 65 * len(w) as b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) as c,
    regexp_matches(text, '[#$%&*|]') as d,
    coalesce(doc_id > min(doc_id) over (partition by text), false) as e
  from d
),
masks as (
  select part, {_bits} as mask, count(*) as n, sum(coalesce(good, 0)) as good,
    sum(coalesce(toxic, 0)) as toxic
  from failed left join l using (doc_id) group by all
),
f as (select unnest(['A', 'B', 'C', 'D', 'E']) as name, unnest([1, 2, 4, 8, 16]) as bit),
orders as (
  select [p.bit, q.bit, r.bit, s.bit, t.bit] as bits,
    p.name || q.name || r.name || s.name || t.name as filter_order
  from f p, f q, f r, f s, f t
  where p.bit + q.bit + r.bit + s.bit + t.bit = 31 and (p.bit | q.bit | r.bit | s.bit | t.bit) = 31
),
steps as (
  select filter_order, step, bits[step] as f,
    coalesce(list_sum(bits[1:step - 1]), 0)::int as earlier
  from orders, (select unnest(range(1, 6)) as step)
),
counted as (
  select part, filter_order, step, f,
    sum(n) filter (where mask & (earlier | f) = 0) as kept,
    sum(n) filter (where mask & f > 0 and mask & earlier = 0) as removed,
    sum(n) filter (where mask & f > 0 and mask & earlier > 0) as redundant,
    sum(n) filter (where mask = f) as unique_fails,
    sum(good) filter (where mask & f > 0 and mask & earlier = 0) as good_lost,
    sum(toxic) filter (where mask & f > 0 and mask & earlier = 0) as toxic_lost
  from masks, steps group by part, filter_order, step, f
)
select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept,
  coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant,
  coalesce(unique_fails, 0)::bigint as unique_fails,
  coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  coalesce(sum(removed) over (partition by part, f), 0)::bigint as shapley
from counted
"""
