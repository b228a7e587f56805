"""SQL (DuckDB dialect) for the operators SQL can express, written apart from the DataFrame code.

The others have none: sketches, a tokenizer, markup, an index and a fitted model are
beyond SQL, and sums of logarithms and cosines differ in the last digits.  They are
tested against brute force.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {}

ORACLES["op4_substring_dedup"] = f"""
with docs as (select row_number() over () as rid, doc_id, coalesce(doc_id, 9223372036854775807) as id, {WORDS} as words from documents),
wins as (
  select rid, id, unnest(range(1, len(words) - 11)) as pos, words from docs where len(words) >= 13),
keyed as (select rid, id, pos, words[pos:pos + 12] as k from wins),
firsts as (select k, min(struct_pack(id := id, pos := pos)) as src from keyed group by k),
gone as (
  select rid, pos, src.id as src, src.pos as src_pos from keyed join firsts using (k) where src.id < keyed.id),
spans as (
  select rid, count(*) as n from (
    select rid, lag(pos) over w as p, lag(src) over w as s, lag(src_pos) over w as q, pos, src, src_pos from gone window w as (partition by rid order by pos))
  where p is null or p <> pos - 1 or s <> src or q <> src_pos - 1 group by rid),
tokens as (
  select rid, pos, words[pos] as word from (select rid, words, unnest(range(1, len(words) + 1)) as pos from docs)),
covered as (
  select tokens.rid, tokens.pos, word, max(case when gone.pos is not null then 1 else 0 end) over (
    partition by tokens.rid order by tokens.pos rows between 12 preceding and current row) as c
  from tokens left join gone on tokens.rid = gone.rid and tokens.pos = gone.pos),
kept as (select rid, sum(c) as n_removed, string_agg(word, ' ' order by pos) filter (c = 0) as left_over from covered group by rid)
select doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(left_over, '')) as kept_sha256,
       coalesce(n, 0)::bigint as n_spans
from docs left join kept using (rid) left join spans using (rid)"""

ORACLES["op6_quality_rules"] = rf"""
with docs as (
  select row_number() over () as rid, doc_id, source, coalesce(text, '') as text, {WORDS} as words,
         string_split(coalesce(text, ''), chr(10)) as lines
  from documents),
tri as (
  select rid, i, count(*) over (partition by rid, words[i], words[i + 1], words[i + 2]) as n
  from (select rid, words, unnest(range(1, len(words) - 1)) as i from docs where len(words) >= 3)),
rep as (
  select rid, count(distinct p) as n_repeat_words from (select rid, unnest([i, i + 1, i + 2]) as p from tri where n > 1) group by rid),
base as (
  select docs.*, len(words) as n_words, length(array_to_string(words, ''))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         [x for x in lines if regexp_matches(x, '[^\x20\x09-\x0D]')] as full_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from docs left join rep using (rid)),
line as (
  select rid, source, text, trim(lower(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g')), ' ') as line,
         len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) as n
  from (select rid, source, text, unnest(lines) as l from docs)),
hosts as (select source, count(distinct text) as texts from docs group by source),
often as (
  select c.source, line from (select source, line, count(distinct text) as n from line where line <> '' group by source, line) c
  join hosts h on c.source is not distinct from h.source where n > 20 and n > 0.1 * texts),
remain as (
  select rid, sum(case when often.line is null then n else 0 end)::bigint as words_left
  from line left join often on line.source is not distinct from often.source and line.line = often.line group by rid)
select doc_id, n_words::bigint as n_words, word_chars, n_symbols::bigint as n_symbols,
       (len(full_lines) - len(list_distinct(full_lines)))::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and words_left >= 0.5 * n_words as kept, words_left
from base join remain using (rid)"""

ORACLES["op10_mix_sources"] = f"""
with docs as (select row_number() over () as rid, doc_id, source, len({WORDS})::bigint as size from documents),
per as (
  select source, sum(size)::bigint as source_size,
         [5, 2, 1][(row_number() over (order by source is null, encode(source)) - 1) % 3 + 1] as weight
  from docs group by source),
ranked as (
  select *, 3 * source_size as cap, row_number() over (order by 3.0 * source_size / weight, source) as k from per),
steps as (
  select k, cap, weight, (select sum(source_size) from per)::bigint as total,
         coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0)::bigint as below,
         sum(weight) over (order by k rows between current row and unbounded following)::bigint as rest
  from ranked),
level as (
  select coalesce(arg_min((total - below)::double / rest::double, k), 0.0) as level from steps where total > 0 and cap > weight * ((total - below)::double / rest::double)),
targets as (
  select source, source_size, least(cap::double, weight * level) as target,
         case when source_size > 0 then least(cap::double, weight * level) / source_size else 0.0 end as rate
  from ranked, level),
draws as (
  select rid, k, ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || (k // 4)), (8 * (k % 4) + 1)::int, 8))::bigint / 4294967296.0 as u
  from docs, (select unnest(range(0, 32)) as k)),
totals as (
  select docs.source as source, k, abs(sum(size * (floor(rate)::bigint + case when u < rate - floor(rate) then 1 else 0 end)) - any_value(target)) as miss
  from docs join targets on docs.source is not distinct from targets.source join draws using (rid) group by docs.source, k),
seeds as (select source, arg_min(k, struct_pack(miss := miss, k := k)) as seed from totals group by source)
select doc_id, size, source_size, target, (size * (floor(rate)::bigint + case when u < rate - floor(rate) then 1 else 0 end))::bigint as taken
from docs join targets on docs.source is not distinct from targets.source join seeds on docs.source is not distinct from seeds.source
     join draws on docs.rid = draws.rid and draws.k = seed"""

ORACLES["op12_line_runs"] = r"""
with docs as (select row_number() over () as rid, doc_id, coalesce(doc_id, 9223372036854775807) as id, coalesce(text, '') as text from documents),
pairs as (select rid, id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from docs),
keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from pairs),
judged as (select *, length(key) >= 10 and min(id) over (partition by key) < id as gone from keyed)
select any_value(doc_id) as doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from docs join judged using (rid) group by rid"""
