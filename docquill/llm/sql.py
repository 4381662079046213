"""DuckDB SQL of the corpus queries that SQL can express; every constant is written out here."""

OP1 = r"""
with payloads as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as payload_digest,
    strlen(coalesce(html, '')) as payload_bytes
  from pages
), groups as (
  select *, max(page_id) over (partition by payload) as top from payloads
)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id <> top then top end as refers_to
from groups
"""

OP2 = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), shingles as materialized (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
  from words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) where len(w) > 0
), sizes as materialized (
  select doc_id, count(*) as n from shingles group by doc_id
), links as materialized (
  select x.a, x.b from (
    select l.doc_id as a, r.doc_id as b, count(*) as same
    from shingles l join shingles r on l.s = r.s and l.doc_id <> r.doc_id group by all
  ) x join sizes p on p.doc_id = x.a join sizes q on q.doc_id = x.b
  where 100 * same >= 80 * (p.n + q.n - same)
), reach(a, b) as (
  select doc_id, doc_id from documents
  union
  select reach.a, links.b from reach join links on links.a = reach.b
), least as (
  select a as doc_id, min(b) as component_id from reach group by a
)
select doc_id, coalesce(n, 0) as n_shingles, component_id from least left join sizes using (doc_id)
"""

OP4 = r"""
with digests as (
  select doc_id, length(coalesce(text, '')) as chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents
), ranked as (
  select *, row_number() over (partition by text_sha256 order by chars desc, doc_id) as place,
    first_value(doc_id) over (partition by text_sha256 order by chars desc, doc_id) as keep_id,
    count(*) over (partition by text_sha256) as group_size
  from digests
)
select doc_id, keep_id, group_size, place = 1 as kept, text_sha256 from ranked
"""

OP9 = r"""
with words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), item_words as (
  select item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), windows as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as phrase
  from item_words, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i)
  where len(w) > 0
), grams as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as phrase
  from words, (select distinct n from windows) l, unnest(range(1, len(w) - n + 2)) t(i)
  where len(w) >= n
), hits as (
  select doc_id, i, g.n, item_id from grams g join windows v on g.n = v.n and g.phrase = v.phrase
), covered as (
  select doc_id, count(distinct p) as n_hit from hits, unnest(range(i, i + n)) t(p) group by doc_id
), named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join covered using (doc_id) left join named using (doc_id)
"""

OP12 = r"""
with split as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from split
), judged as (
  select *, length(k) >= 10 and doc_id > min(doc_id) over (partition by k) as goes from keyed
)
select doc_id, count(*) as n_lines, count(*) filter (goes) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not goes), '')) as kept_sha256
from judged group by doc_id
"""

OP13 = r"""
with pieces as (
  select doc_id, coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), words as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), totals as (
  select lang, cast(sum(len(w)) as bigint) as n from words group by lang
), counts as materialized (
  select lang, size, array_to_string(w[i:i + size - 1], ' ') as phrase, any_value(w[i:i + size - 1]) as p, count(*) as f
  from words, (values (1), (2), (3)) s(size), unnest(range(1, len(w) - size + 2)) t(i)
  group by 1, 2, 3 having count(*) >= 10
), inner_of as (
  select lang, phrase, max(f) as longer from (
    select lang, f, unnest([array_to_string(p[1:2], ' '), array_to_string(p[2:3], ' ')]) as phrase from counts where size = 3
  ) group by all
), candidates as (
  select c.*, unnest(range(1, size)) as k from counts c left join inner_of i using (lang, phrase)
  where size = 3 or size = 2 and (longer is null or 100 * longer < 50 * f)
), cuts as (
  select c.lang, c.phrase, c.f as a, k, x.f as l, y.f as r,
    cast(1000000 * cast(c.f as hugeint) * c.f // (cast(x.f as hugeint) * y.f) as bigint) as score
  from candidates c
  join counts x on x.lang = c.lang and x.phrase = array_to_string(c.p[1:k], ' ')
  join counts y on y.lang = c.lang and y.phrase = array_to_string(c.p[k + 1:], ' ')
), best as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best
)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""

# The grammar as four states: 0 nothing yet, 1 after s, 2 after u, 3 after a. Least cost and audit per state, row by row.
OP11 = r"""
with recursive crc as (
  select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, _: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) order by i) as t
  from range(256) r(i)
), numbered as (
  select *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(
      coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda x: cast(ascii(x) as bigint))),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 20 as kind
  from conversations, crc
), damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else coalesce(role, ' ') end as role,
    case kind when 1 then '' when 2 then regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') else coalesce(text, ' ') end as text
  from numbered, range(case kind when 0 then 0 when 3 then 2 else 1 end)
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') as bare
  from damaged
), faulty as (
  select *, substr(role, 1, 1) as initial, case when bare = '' then 'blank'
      when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
      when right(bare, 1) not in ('.', '!', '?') then 'truncated' end as fault,
    lag(substr(role, 1, 1)) over (partition by conv_id order by i) as before
  from placed
), numbers as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
  from faulty group by conv_id
), inserted(p, q, ins, added) as (
  values (0, 0, '', []), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []), (0, 2, 'I', ['user:']), (1, 2, 'I', ['user:']),
    (3, 2, 'I', ['user:']), (2, 3, 'I', ['assistant:']), (0, 3, 'II', ['user:', 'assistant:']),
    (1, 3, 'II', ['user:', 'assistant:']), (3, 3, 'II', ['user:', 'assistant:']), (2, 2, 'II', ['assistant:', 'user:'])
), walk as (
  select conv_id, cast(0 as bigint) as i, 0 as state, cast(0 as bigint) as cost, '' as audit, cast([] as varchar[]) as lines
  from numbers
  union all
  (select conv_id, i, state, cost, audit, lines from (
    select w.conv_id, f.i, e.state, w.cost + 2 * length(s.ins) + e.cost as cost, w.audit || s.ins || e.edit as audit,
      w.lines || s.added || e.line as lines
    from walk w join faulty f on f.conv_id is not distinct from w.conv_id and f.i = w.i + 1
    join inserted s on s.p = w.state,
    lateral (
      select 'D' as edit, s.q as state, 3 as cost, cast([] as varchar[]) as line
      union all select 'K', case when f.initial = 's' then 1 when s.q = 2 then 3 else 2 end, case when f.fault = 'truncated' then 1 else 0 end,
        [f.role || ':' || f.text]
      where coalesce(f.fault, 'truncated') = 'truncated' and (f.initial = 's' and s.q = 0 or f.initial = 'u' and s.q <> 2 or f.initial = 'a' and s.q = 2)
      union all select 'R', case when s.q = 2 then 3 else 2 end, case when f.fault = 'truncated' then 3 else 2 end,
        [case when s.q = 2 then 'assistant' else 'user' end || ':' || f.text]
      where coalesce(f.fault, 'truncated') = 'truncated' and f.initial <> case when s.q = 2 then 'a' else 'u' end
    ) e
  ) qualify row_number() over (partition by conv_id, state order by cost, audit) = 1)
), closed as (
  select w.conv_id, w.cost + 2 * length(ins) as cost, w.audit || ins as audit, w.lines || added as lines
  from walk w join numbers n on n.conv_id is not distinct from w.conv_id and n.n = w.i join inserted s on s.p = w.state
  where q = 3 or q = 0 and ins = ''
  qualify row_number() over (partition by w.conv_id order by w.cost + 2 * length(ins), w.audit || ins) = 1
), ids as (
  select distinct conv_id from conversations
)
select ids.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit,
  sha256(coalesce(array_to_string(lines, chr(10)), '')) as repaired_sha256
from ids left join numbers n on n.conv_id is not distinct from ids.conv_id left join closed c on c.conv_id is not distinct from ids.conv_id
"""

SQL = {"op11_dialogue_repair": OP11, "op13_phrase_mining": OP13, "op12_line_dedup": OP12, "op1_capture_index": OP1, "op2_parity_sketch_join": OP2, "op4_perfect_hash_dedup": OP4, "op9_fm_decontamination": OP9}
