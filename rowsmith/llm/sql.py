"""SQL twins, in DuckDB's dialect, of the queries that SQL can express."""

from __future__ import annotations

from rowsmith.llm.license_templates import TEMPLATES

_SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLE: dict[str, str] = {}

ORACLE["op1_source_mixing"] = f"""
with sized as (select doc_id, source, text, cast({_SIZE} as bigint) as size from documents),
counted as (select source, sum(size) as source_size from sized group by source),
weighed as (
  select source, source_size, cast(3 * source_size as hugeint) as room,
         cast(1 + (row_number() over (order by source nulls last) - 1) % 3 as hugeint) as weight
  from counted
),
sums as (select sum(source_size) as total, sum(weight) as shares from weighed),
-- Sources in the order in which they reach their room as the shares grow.
running as (
  select *, coalesce(sum(room) over upto, 0) as room_before, coalesce(sum(weight) over upto, 0) as weight_before
  from weighed, sums
  window upto as (order by room / cast(weight as double), source nulls last
                  rows between unbounded preceding and 1 preceding)
),
level as (
  select total - room_before as remaining, shares - weight_before as open_shares
  from running
  where room * (shares - weight_before) > (total - room_before) * weight
  order by room / cast(weight as double), source nulls last limit 1
),
targets as (
  select source, source_size,
         case when room * open_shares <= remaining * weight then cast(room as double)
              else cast(remaining * weight as double) / cast(open_shares as double) end as target
  from weighed, level
),
needs as (
  select *, case when source_size > 0 then cast(round(target) as bigint) // source_size else 0 end as whole,
         case when source_size > 0 then cast(round(target) as bigint) % source_size else 0 end as need
  from targets
),
turns as (
  select doc_id, source, size,
         cast('0x' || substr(md5('20240601:' || coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')), 1, 15) as bigint) as turn
  from sized
),
tied as (
  select source, turn, sum(size) as inside, count(*) as ties, min(size) as each
  from turns where size > 0 group by source, turn
),
ordered as (
  select *, sum(inside) over (partition by source order by turn rows between unbounded preceding and current row) as upto
  from tied
),
cuts as (
  select n.source, o.turn as cut_turn, n.need - (o.upto - o.inside) as missing, each
  from needs n join ordered o on n.source is not distinct from o.source
  where o.upto - o.inside < n.need and n.need <= o.upto
),
-- Repeated rows, which share a turn, in any order.
placed as (select *, row_number() over (partition by source, turn, size > 0) - 1 as place from turns)
select t.doc_id, t.size, cast(n.source_size as bigint) as source_size, n.target,
       cast(n.whole * t.size + case when t.turn < coalesce(c.cut_turn, 0) then t.size
                                    when t.size = 0 or t.turn > coalesce(c.cut_turn, 0) then 0
                                    else least(each, greatest(0, missing - place * each)) end as bigint) as taken
from placed t join needs n on t.source is not distinct from n.source
left join cuts c on t.source is not distinct from c.source
"""

ORACLE["op8_url_filter"] = r"""
with recursive plain as (
  select row_number() over () as r, page_id, url, html from pages
),
parts as (
  select r, page_id, html, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
    coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*(\?[^#]*)', 1), '') as query,
    contains(url, '://') as absolute
  from plain
),
links as (
  select url, case when absolute then host || path || query end as a, path as page_path,
         regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) as site,
         replace(unnest(list_concat(
           [regexp_extract(t, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1) for t in
             regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>')],
           [regexp_extract(t, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1) for t in
             regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>')])), '&amp;', '&') as t
  from parts
),
-- A link is an url, or names another place from its page's: site, folder or page.
placed as (
  select *, regexp_extract(t, '(?s)^[^?#]*(.*)$', 1) as rest,
    case when starts_with(t, '/') then '' else coalesce(nullif(regexp_extract(page_path, '(?s)^(.*/)', 1), ''), '/') end
      || regexp_extract(t, '(?s)^([^?#]*)', 1) as long_path
  from links where t <> ''
),
cut as (select *, string_split(long_path, '/')[2:] as segments from placed),
folding as (
  select *, list_reduce(list_prepend(cast([] as varchar[]), [[x] for x in segments]), lambda done, x:
    case when x[1] = '..' then done[1:greatest(len(done) - 1, 0)] when x[1] = '.' then done else list_concat(done, x) end) as done
  from cut
),
resolved as (
  select a, case
    when regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.\-]*://') then t
    when regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.\-]*:') or a is null then null
    when starts_with(t, '//') then regexp_extract(url, '(?s)^(.*?:)//', 1) || t
    when starts_with(t, '#') then url
    when starts_with(t, '?') then site || page_path || t
    else site || '/' || array_to_string(done, '/')
      || case when segments[-1] in ('.', '..') and len(done) > 0 then '/' else '' end || rest
    end as t
  from folding
),
edges as (
  select a, translate(regexp_extract(t, '(?s)^.*?://([^/?#]*)', 1),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
            || regexp_extract(t, '(?s)^.*?://[^/?#]*([^?#]*)', 1)
            || regexp_extract(t, '(?s)^.*?://[^?#]*(\?[^#]*)', 1) as b
  from resolved where contains(t, '://') and a is not null
),
both_ways as (select a, b from edges union select b, a from edges),
reach as (
  select a as node, a as other from both_ways
  union
  select r.node, e.b from reach r join both_ways e on r.other = e.a
),
rules as (
  select * from (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
  ) as r (verdict, rule_host, rule_path)
),
targets as (
  select distinct other,
    regexp_extract('x://' || other, '(?s)^.*?://([^/?#]*)', 1) as host,
    regexp_extract('x://' || other, '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from reach
),
judged_targets as (
  select other, arg_max(verdict, length(rule_host || rule_path)) as verdict
  from targets join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by other
),
blocked as (
  select r.node from reach r join judged_targets t using (other) group by r.node
  having bool_or(t.verdict = 'block') and not bool_or(t.verdict = 'allow')
),
fitting as (
  select p.r, page_id, p.host, p.path, p.query, p.absolute,
    arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
    arg_max(verdict, length(rule_host || rule_path)) as verdict
  from parts p left join rules
    on (p.host = rule_host or ends_with(p.host, '.' || rule_host)) and starts_with(p.path, rule_path)
  group by all
)
select page_id, f.host, f.path, f.rule,
  coalesce(f.verdict, case when b.node is not null then 'block' else 'allow' end) as verdict
from fitting f left join blocked b on f.absolute and b.node = f.host || f.path || f.query
"""

_SHINGLED = r"""
{name} as (
  select {id}, string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+') as raw from {source}
),
{name}_words as (select {id}, list_filter(raw, lambda x: x <> '') as words from {name}),
{name}_shingles as (
  select distinct {id}, case when len(words) < 5 then array_to_string(words, ' ')
    else array_to_string(words[i:i + 4], ' ') end as shingle
  from {name}_words, unnest(range(1, greatest(len(words) - 3, 2))) as t(i)
  where len(words) > 0
)
"""


def _contained(id_name: str, parts: str, left: str) -> str:
    """Documents with at least 4/5 of the shingles of an entry of ``left``."""
    return f"""
with {parts},
sizes as (select {id_name}, count(*) as n_shingles from {left}_shingles group by {id_name}),
common as (
  select doc_id, {id_name}, count(*) as matched
  from docs_shingles join {left}_shingles using (shingle) group by doc_id, {id_name}
)
select doc_id, {id_name}, n_shingles, matched from common join sizes using ({id_name})
where 5 * matched >= 4 * n_shingles
"""


_DOCS = _SHINGLED.format(name="docs", id="doc_id", source="documents")

ORACLE["op9_decontamination"] = r"""
with docs as (
  select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as words
  from documents
),
items as (
  select item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as words
  from benchmark where item_id is not null
),
sized as (select item_id, words, least(5, len(words)) as k from items where len(words) > 0),
item_shingles as (
  select distinct item_id, k, array_to_string(words[i:i + k - 1], ' ') as shingle
  from sized, unnest(range(1, len(words) - k + 2)) as t(i)
),
lengths as (select distinct k from sized),
doc_shingles as (
  select distinct doc_id, k, array_to_string(words[i:i + k - 1], ' ') as shingle
  from docs, lengths, unnest(range(1, greatest(len(words) - k + 2, 1))) as t(i)
),
sizes as (select item_id, count(*) as n_shingles from item_shingles group by item_id),
common as (
  select doc_id, item_id, count(*) as matched
  from doc_shingles join item_shingles using (k, shingle) group by doc_id, item_id
)
select doc_id, item_id, n_shingles, matched from common join sizes using (item_id)
where 5 * matched >= 4 * n_shingles
"""

_TEMPLATE_ROWS = ", ".join(
    "('{}', '{}')".format(*[part.replace("'", "''") for part in pair]) for pair in TEMPLATES.items()
)
ORACLE["op5_license_scan"] = _contained(
    "license",
    f"templates as (select * from (values {_TEMPLATE_ROWS}) as v (license, text)),"
    + _DOCS + "," + _SHINGLED.format(name="notices", id="license", source="templates"),
    "notices",
)

ORACLE["op3_line_rules"] = r"""
with texts as (select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents),
split as (
  select r, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
         string_split(text, chr(10)) as lines
  from texts
),
windows as (
  select r, i, words[i:i + 2] as trio, count(*) over (partition by r, words[i:i + 2]) as n
  from split, unnest(range(1, len(words) - 1)) as t(i)
),
covered as (
  select r, count(distinct i + k) as n_repeat_words
  from windows, unnest([0, 1, 2]) as o(k) where n >= 2 group by r
),
each as (
  select r, source, hash(text) as same, lines[i] as line, i,
         regexp_replace(array_to_string(regexp_extract_all(
           translate(lines[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+'), ' '), '[0-9]', '0', 'g') as normal,
         len(regexp_extract_all(lines[i], '[^\x20\x09-\x0D]+')) as line_words
  from split, unnest(range(1, len(lines) + 1)) as t(i)
),
repeats as (
  select r, count(*) as n_dup_lines
  from (select r, line_words, row_number() over (partition by r, line order by i) as place from each)
  where place > 1 and line_words > 0 group by r
),
frequent as (
  select e.source, normal, count(distinct same) as documents from each e
  where line_words > 0 group by e.source, normal
),
boilerplate as (select source, normal from frequent where documents > 20),
removed as (
  select r, sum(line_words) as removed_words, count(*) as n_removed_lines
  from each e join boilerplate b on line_words > 0 and e.source is not distinct from b.source and e.normal = b.normal
  group by r
),
counted as (
  select r, doc_id, cast(len(words) as bigint) as n_words,
         cast(len(array_to_string(words, '')) as bigint) as word_chars,
         cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols
  from split
),
merged as (
  select doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(removed_words, 0) as lost,
         coalesce(n_removed_lines, 0) as n_removed_lines
  from counted left join repeats using (r) left join covered using (r) left join removed using (r)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_lines,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
         and 100 * lost <= 50 * n_words and n_words - lost >= 50 as kept
from merged
"""

_LETTERS = "select * from (values ('A'), ('B'), ('C'), ('D'), ('E')) as v (l)"

ORACLE["op12_filter_audit"] = rf"""
with letters as ({_LETTERS}),
plain as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
),
-- A row without an id neither is a copy nor has copies.
facts as (
  select doc_id, part,
    concat(case when len(words) < 50 then 'A' else '' end,
           case when 100 * len(list_distinct(words)) < 65 * len(words) then 'B' else '' end,
           case when 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * len(text) then 'C' else '' end,
           case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end,
           case when doc_id > min(doc_id) over (partition by text) then 'E' else '' end) as fails
  from plain
),
marks as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id
),
cells as (
  select part, fails, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from facts left join marks using (doc_id) group by part, fails
),
orders as (
  select a.l || b.l || c.l || d.l || e.l as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
),
-- The first filter of the order that a cell fails; 6 for none.
stopped as (
  select c.*, filter_order,
    coalesce(list_min([strpos(filter_order, fails[i]) for i in range(1, len(fails) + 1)]), 6) as place
  from cells c, orders
),
steps as (
  select part, filter_order, cast(step as integer) as step, filter_order[step] as letter,
    sum(case when place > step then n else 0 end) as kept,
    sum(case when place = step then n else 0 end) as removed,
    sum(case when place < step and contains(fails, filter_order[step]) then n else 0 end) as redundant,
    sum(case when fails = filter_order[step] then n else 0 end) as unique_fails,
    sum(case when place = step then good else 0 end) as good_lost,
    sum(case when place = step then toxic else 0 end) as toxic_lost
  from stopped, range(1, 6) as s(step)
  group by all
)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, letter) as bigint) as shapley
from steps
"""


def _assignment(turn: int) -> str:
    """Nearest centroid of every vector, and the centroids that follow from it."""
    return f"""
near{turn} as (
  select r, vec_id, whole, m.cluster, m.distance from (
    select r, any_value(v.vec_id) as vec_id, any_value(v.whole) as whole,
      min(struct_pack(distance := list_sum([(v.whole[i] - c.whole[i]) * (v.whole[i] - c.whole[i]) for i in range(1, 65)]),
                      cluster := c.cluster)) as m
    from kept v, centres{turn} c group by r
  )
),
sums{turn} as (
  select cluster, i, sum(whole[i]) as total, count(*) as n from near{turn}, range(1, 65) as t(i) group by cluster, i
),
means{turn} as (
  select cluster, list(cast((total - ((total % n) + n) % n) // n as bigint) order by i) as whole
  from sums{turn} group by cluster
),
centres{turn + 1} as (
  select c.cluster, coalesce(m.whole, c.whole) as whole from centres{turn} c left join means{turn} m using (cluster)
)"""


ORACLE["op13_centroids"] = f"""
with numbered as (
  select row_number() over () as r, vec_id, [cast(x as double) for x in embedding] as parts from embeddings
),
kept as (
  select r, vec_id, [cast(floor(64 * x) as bigint) for x in parts] as whole from numbered
  where len(parts) = 64 and len([x for x in parts if x is null or not isfinite(x)]) = 0
),
centres0 as (
  select row_number() over (order by sha256('1:' || vec_id) nulls last, whole) - 1 as cluster, whole from kept
  order by sha256('1:' || vec_id) nulls last, whole limit 16
),
{",".join(_assignment(turn) for turn in range(4))}
select vec_id, cast(cluster as integer) as cluster, cast(distance as bigint) as distance,
  cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
  cast(sum(distance) over () as bigint) as inertia,
  sha256(array_to_string(c.whole, ',')) as centroid_sha256
from near3 join centres3 c using (cluster)
"""

ORACLE["op6_chat_format"] = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, i, r, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) as v (i, r)
),
-- A backslash gets another before it, and one parts the start of a control string; three control strings a turn.
sized as (
  select *, length(role || text) + length(regexp_replace(role || chr(10) || text, '[^\\]', '', 'g'))
    + (length(role) - length(replace(role, '<|', '')) + length(text) - length(replace(text, '<|', ''))) // 2 + 23 as chars
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars
from sized group by conv_id
"""
