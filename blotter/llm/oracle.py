"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from blotter.llm.rule_cascade import STOP_TEXT

#: Whole ``pages``: the list's own members are looked up without any filter.
OP4 = r"""
with p as (
  select page_id, url,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path,
    coalesce(regexp_extract(url, '://[^?#]*\?([^#]*)', 1), '') as query
  from pages),
q as (
  select *, array_to_string(list_sort(list_filter(string_split(query, '&'),
      lambda x: x <> '' and not regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&') as kept
  from p),
c as (
  select *, case when contains(url, '://') then
      regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
      || case when kept <> '' then '?' || kept else '' end
    else '' end as key
  from q),
l as (
  select distinct key from c
  where regexp_matches(host, '(^|[.-])(bets|casino|pills|spam)([.-]|$)') and key <> ''),
r as (
  select c.page_id, c.host, c.path, l.key is not null as listed,
    case
      when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
      when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
      when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
      when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/'
    end as rule
  from c left join l on c.key = l.key)
select page_id, host, path, rule, listed,
  case when rule in ('net/', 'example.com/de/') then 'block'
       when rule in ('example.net/en/', 'org/fr/') then 'allow'
       when listed then 'block' else 'allow' end as verdict
from r
"""

#: Whole ``conversations``: levels by recursion, canonical JSON written out.
OP10 = r"""
with recursive t as (
  select conv_id, turn, role, text from conversations where conv_id is not null and turn is not null),
calls as (
  select conv_id, turn, conv_id || '-' || turn as call_id, role = 'user' as reply, text,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words,
    conv_id || '-' || (turn // 2) as needs
  from t where role in ('system', 'user')),
lv as (
  select call_id, 0 as level from calls
  where turn = 0 or needs not in (select call_id from calls)
  union all
  select c.call_id, lv.level + 1 from calls c join lv on c.needs = lv.call_id where c.turn > 0),
res as (
  select conv_id || '-' || (turn - 1) as call_id, count(*) as n_results, min(turn) as turn,
    min(conv_id) as conv_id, arg_min(text, turn) as content
  from t where role = 'assistant' group by 1),
e as (
  select c.*, lv.level, r.content, coalesce(r.n_results, 0) as n_results,
    case when reply then concat_ws('; ',
        case when text is null then 'prompt: missing' when length(text) < 20 then 'prompt: too small' end,
        case when words < 5 then 'words: too small' end)
      else concat_ws('; ', case when text is null then 'instruction: missing'
        when length(text) < 1 then 'instruction: too small' end) end as errors
  from calls c join lv on c.call_id = lv.call_id left join res r on c.call_id = r.call_id)
select conv_id, turn, call_id, case when reply then 'reply' else 'configure' end as name,
  cast(level as int) as level,
  case when errors <> '' then 'invalid' when n_results = 0 then 'unanswered' else 'ok' end as status,
  errors, n_results,
  '{"arguments":' || case when reply
      then '{"depth":' || (turn // 2) || case when text is null then '' else ',"prompt":' || to_json(text) end || ',"words":' || words || '}'
      else '{' || case when text is null then '' else '"instruction":' || to_json(text) || ',' end || '"strict":true}' end
    || ',"id":"' || call_id || '","name":"' || case when reply then 'reply' else 'configure' end || '"'
    || case when content is null then '' else ',"result":' || to_json(content) end || '}' as json
from e
union all
select conv_id, turn, call_id, null, null, 'orphan result', '', n_results,
  '{"id":"' || call_id || '"' || case when content is null then '' else ',"result":' || to_json(content) end || '}'
from res where call_id not in (select call_id from calls)
"""

#: Whole ``documents``: every rule for every text, passages by grouping.
OP11 = r"""
with d as (
  select doc_id, row_number() over () as k, coalesce(text, '') as text from documents),
w as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from d),
p as (
  select k, i - 1 as place, array_to_string(words[i:i + 7], ' ') as passage
  from (select k, words, unnest(range(1, len(words) - 6)) as i from w)),
r as (
  select k, count(distinct place + step) as n_repeat_words
  from (select k, place, unnest(range(8)) as step
        from (select k, place, count(*) over (partition by k, passage) as times from p) where times > 1)
  group by k),
c as (
  select doc_id, len(words) as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words,
    len(lines) as n_lines,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) as capitals,
    length(regexp_replace(text, '[^\x21-\x40\x5B-\x60\x7B-\x7E]', '', 'g')) as marks,
    length(regexp_replace(text, '[^!]', '', 'g')) as exclamations,
    len(list_intersect(list_transform(words, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz')), [STOP_WORDS])) as stop_words,
    coalesce(list_max(map_values(list_histogram(words))), 0) as most_frequent,
    coalesce(list_max(list_transform(words, lambda x: length(x))), 0) as longest
  from w left join r using (k)),
f as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from c)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 10 * n_symbols > n_words or 2 * n_dup_lines > n_lines
    or not word_chars between 3 * n_words and 10 * n_words or 10 * capitals > 4 * word_chars
    or 10 * marks > 3 * word_chars or 2 * exclamations > n_words or stop_words < 2
    or 4 * most_frequent > n_words or longest > 500) as kept
from f
""".replace("STOP_WORDS", ", ".join(sorted(f"'{w}'" for w in STOP_TEXT.split())))

#: Whole ``documents``: levels by recursion; CRC-32 by its table, which a rule builds.
OP12 = r"""
with recursive t as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as crc_table),
d as (
  select *, xor(list_reduce(list_prepend(4294967295::bigint,
      list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint)),
      lambda a, b: xor(a >> 8, crc_table[(xor(a, b) & 255) + 1])), 4294967295) % 7 = 0 as tampered
  from documents, t),
s as (
  select doc_id, lang, tampered,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') as head,
    coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as n,
    coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') as n_later,
    coalesce(strlen(text) || ':' || text, '-') as body
  from d),
leaves as materialized (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos
  from (select doc_id, lang, sha256(head || n || body) as leaf,
    sha256(head || case when tampered then n_later else n end || body) as found from s)),
up as (
  select lang, 0 as level, pos, leaf as h, count(*) over (partition by lang) as many from leaves
  union all
  select lang, level + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (min(many) + 1) // 2
  from up where many > 1 group by lang, level, pos // 2),
roots as materialized (
  select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as pos from up where many = 1),
top as (
  select 0 as level, pos, subroot as h, count(*) over () as many from roots
  union all
  select level + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (min(many) + 1) // 2
  from top where many > 1 group by level, pos // 2),
sib as materialized (
  select u.lang, u.level, u.pos, coalesce(v.h, '') as h, u.pos % 2 = 1 as is_left
  from up u left join up v on u.lang is not distinct from v.lang and u.level = v.level and v.pos = xor(u.pos, 1)
  where u.many > 1
  union all
  select r.lang, 1000 + u.level, -1, coalesce(v.h, ''), u.pos % 2 = 1
  from roots r join top u on u.pos = r.pos // (1 << u.level) left join top v on u.level = v.level and v.pos = xor(u.pos, 1)
  where u.many > 1),
way as materialized (
  select l.doc_id, l.pos as leaf_pos, l.lang, s.h, s.is_left,
    row_number() over (partition by l.lang, l.pos order by s.level) as step
  from leaves l join sib s on s.lang is not distinct from l.lang
    and (s.pos = -1 or s.pos = l.pos // (1 << case when s.level < 1000 then s.level else 0 end))),
fold as (
  select lang, pos, 1 as step, found as h from leaves
  union all
  select f.lang, f.pos, f.step + 1, sha256(case when w.is_left then w.h || f.h else f.h || w.h end)
  from fold f join way w on w.lang is not distinct from f.lang and w.leaf_pos = f.pos and w.step = f.step),
ends as (select lang, pos, arg_max(h, step) as folded_root from fold group by lang, pos),
proofs as (select lang, leaf_pos as pos, sha256(string_agg(h, '' order by step)) as proof_sha256 from way group by lang, leaf_pos)
select l.doc_id, l.leaf, r.subroot, t.h as root, coalesce(p.proof_sha256, sha256('')) as proof_sha256,
  e.folded_root, e.folded_root = t.h as verified
from leaves l join roots r on r.lang is not distinct from l.lang join top t on t.many = 1
join ends e on e.lang is not distinct from l.lang and e.pos = l.pos
left join proofs p on p.lang is not distinct from l.lang and p.pos = l.pos
"""

ORACLE: dict[str, str] = {"op4_bloom_url_filter": OP4, "op10_tool_call_linking": OP10, "op11_rule_cascade": OP11, "op12_merkle_manifest": OP12}
