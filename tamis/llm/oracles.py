"""DuckDB SQL of the queries that SQL can express on whole tables. Ids of documents are taken to be unique, as in the tables."""

from __future__ import annotations

import re

from tamis.llm import licenses, line_rules, mixing, phrases, url_rules

WORD = r"[^\x20\x09-\x0D]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def any_of(names: tuple[str, ...]) -> str:
    return "|".join(re.escape(p).replace("\\ ", r"\s+").replace("'", "''") for p in sorted(names, key=len, reverse=True))


def line_rules_sql() -> str:
    marks, closers = "".join(line_rules.END_MARKS), "".join("\\" + c if c in "])}" else c for c in line_rules.CLOSERS).replace("'", "''")
    edge = r"[^\pL\pN_]"
    return f"""
with d as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
grams as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as gram from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d)),
twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, gram) as n from grams) where n > 1),
repeats as (select doc_id, count(distinct i + k) as n from twice, range(3) t(k) group by doc_id),
lines as (select doc_id, line, regexp_extract_all(line, '{WORD}') as w from (select doc_id, unnest(string_split(text, chr(10))) as line from d)),
judged as (
  select doc_id, line, len(w) as n,
    (len(w) > 2 and len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&|<>]'))) > {line_rules.SYMBOL_SHARE} * len(w))
    or len(line) - len(replace(line, ' | ', '12')) >= {line_rules.MENU_ITEMS - 1}
    or (len(w) <= {line_rules.SHORT_LINE} and regexp_matches(line, '(?i)^{edge}*(?:{any_of(line_rules.NAVIGATION_PHRASES)}){edge}*$'))
    or (len(w) <= {line_rules.NOTICE_LINE} and regexp_matches(line, '(?i)(?:^|{edge})(?:{any_of(line_rules.BOILERPLATE_PHRASES)})(?:$|{edge})'))
    or (len(w) >= {line_rules.SENTENCE_LINE} and not regexp_matches(w[-1], '[{marks}][{closers}]*$')) as fails
  from lines where len(w) > 0),
per as (select doc_id, count(*) - count(distinct line) as dup, coalesce(sum(n) filter (fails), 0) as lost from judged group by doc_id),
counts as (
  select d.doc_id, len(d.w) as n_words, length(array_to_string(d.w, '')) as word_chars, length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    coalesce(per.dup, 0) as n_dup_lines, coalesce(repeats.n, 0) as n_repeat_words, coalesce(per.lost, 0) as lost_words
  from d left join per using (doc_id) left join repeats using (doc_id)),
failed as (select *, n_words < {line_rules.LEAST_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed from counts)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
  cast(n_repeat_words as bigint) as n_repeat_words, base_failed, not base_failed and lost_words <= {line_rules.MOST_LOST} * n_words as kept, cast(lost_words as bigint) as lost_words
from failed"""


def licenses_sql() -> str:
    base = ", ".join(f"({quoted(label)}, '', {quoted(phrase)}, 1000, 1.0, true)" for phrase, label in licenses.BASE)
    own = ", ".join(f"({quoted(label)}, {quoted(keyword)}, {quoted(pattern)}, {priority}, {confidence}, false)" for label, keyword, pattern, priority, confidence in licenses.rules())
    gate = " or ".join(f"contains(line, {quoted(w)})" for w in licenses.gate_words(licenses.rules()))
    return rf"""
with rules(label, keyword, pattern, priority, confidence, is_base) as (values {base}, {own}),
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
lines as (select doc_id, w, ' ' || array_to_string(w, ' ') || ' ' as line from d),
gated as (select doc_id, w, line from lines where {gate}),
hit as materialized (select doc_id, w, label, pattern, priority, confidence, is_base from gated, rules where contains(line, keyword) and regexp_matches(line, ' (?:' || pattern || ') ')),
spots as (select *, i - 1 as spot, ' ' || array_to_string(w[i:i + 40], ' ') || ' ' as rest from (select *, unnest(range(1, len(w) + 1)) as i from hit)),
matched as (select doc_id, label, priority, confidence, is_base, spot, regexp_extract(rest, '^ (' || pattern || ') ', 1) as m from spots),
found as (select doc_id, label, priority, confidence, is_base, spot, spot + length(m) - length(replace(m, ' ', '')) + 1 as stop from matched where m <> ''),
own as (
  select f.* from found f where not is_base and not exists (
    select 1 from found o where o.doc_id = f.doc_id and not o.is_base and o.spot <= f.spot and o.stop >= f.stop
      and (o.priority > f.priority or o.priority = f.priority and o.stop - o.spot > f.stop - f.spot))),
base as (select doc_id, count(*) as n, min(spot) as first_word, max(spot) as last_word, string_agg(distinct label, ',' order by label) as labels from found where is_base group by doc_id),
every as (select doc_id, string_agg(distinct label, ',' order by label) as labels, max(confidence) as score from (select * from own union all select * from found where is_base) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(base.n, 0) as bigint) as n_base, cast(base.first_word as bigint) as first_word, cast(base.last_word as bigint) as last_word,
  coalesce(base.labels, '') as base_labels, coalesce(every.labels, '') as labels, cast(coalesce(every.score, 0) as double) as score
from d left join base using (doc_id) left join every using (doc_id)"""


def mixing_sql() -> str:
    weights = ", ".join(f"({k}, {w})" for k, w in enumerate(mixing.WEIGHTS))
    most, grid = mixing.MOST, mixing.GRID
    passes, taken = "", "false"
    for k in range(mixing.PASSES):
        last = k == mixing.PASSES - 1
        fits = "run - size / 2.0 <= room" if last else "run <= room"
        passes += f""",
tried{k} as (select p.*, r.room, sum(p.size) over (partition by p.s order by p.odds, p.doc_id, p.h) as run
  from {'placed' if not k else f'left{k - 1}'} p join room{k} r on p.s = r.s where p.rest > 0 and p.size <= {2 if last else 1} * r.room),
taken{k} as (select doc_id, s, size from tried{k} where {fits}),
left{k} as (select * from {'placed' if not k else f'left{k - 1}'} where doc_id not in (select doc_id from taken{k})),
room{k + 1} as (select r.s, r.room - coalesce((select sum(size) from taken{k} t where t.s = r.s), 0) as room from room{k} r)"""
        taken += f" or p.doc_id in (select doc_id from taken{k})"
    return rf"""
with d as (select doc_id, coalesce(source, chr(1114111)) as s, text, regexp_extract_all(coalesce(text, ''), '{WORD}') as w,
    md5('{mixing.SEED}:' || coalesce(cast(doc_id as varchar), 'null') || ':' || coalesce(source, 'null') || ':' || coalesce(md5(text), 'null')) as h from documents),
rows as (select doc_id, s, h, len(w) as size, (cast('0x' || substr(h, 1, 13) as bigint) + 0.5) / 4503599627370496.0::double as u,
    case when len(w) > 0 then round(log2(len(list_distinct(w)) / len(w)::double) * {grid}) else 0 end as grid from d),
sources as (select s, sum(size) as source_size, row_number() over (order by s) - 1 as k from rows group by s),
weighted as (select sources.*, w.w::double as weight, {most} * source_size as cap from sources join (values {weights}) w(m, w) on k % {len(mixing.WEIGHTS)} = w.m),
levels as (select *, ({mixing.SHARE} * sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, k rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by cap / weight, k rows between current row and unbounded following) as level from weighted),
goals as (select s, source_size, least(cap, coalesce((select arg_min(level, (cap / weight, k)) from levels where level * weight <= cap) * weight, cap)) as target from levels),
grids as (select s, grid, sum(size) as words, pow(2, grid / {grid}.0) as imp from rows group by s, grid),
factors as (select g.s, g.grid, g.imp, ({'t.target'} - {most} * coalesce(sum(words) over (partition by g.s order by grid desc rows between unbounded preceding and 1 preceding), 0))
    / nullif(sum(words * imp) over (partition by g.s order by grid desc rows between current row and unbounded following), 0) as factor from grids g join goals t on g.s = t.s),
chosen as (select s, arg_max(coalesce(factor, 0), grid) as factor from factors where coalesce(factor, 0) * imp <= {most} * (1 + 1e-9) group by s),
expected as (select r.*, g.source_size, g.target, round(least({most}, coalesce(c.factor, 0) * pow(2, r.grid / {grid}.0)), 9) as e
  from rows r join goals g on r.s = g.s left join chosen c on c.s = r.s),
placed as (select doc_id, s, h, size, source_size, target, floor(e) as sure, e - floor(e) as rest, case when e > floor(e) then (u / (1 - u)) * ((1 - (e - floor(e))) / (e - floor(e))) end as odds from expected),
room0 as (select s, any_value(target) - sum(size * sure) as room from placed group by s){passes}
select p.doc_id, cast(p.size as bigint) as size, cast(p.source_size as bigint) as source_size, p.target, cast((p.sure + case when {taken} then 1 else 0 end) * p.size as bigint) as taken,
  nullif(p.s, chr(1114111)) as source, cast(p.sure + case when {taken} then 1 else 0 end as bigint) as copies
from placed p"""


def near_duplicates_sql() -> str:
    return rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '{WORD}') as w from documents),
sets as (select doc_id, unnest(list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)) as g from d),
sized as (select doc_id, count(*) as n, md5(string_agg(g, chr(10) order by g)) as same from sets group by doc_id),
kinds as (select same, min(doc_id) as least, any_value(n) as n from sized group by same),
terms as (select least as doc_id, g from kinds join sets on sets.doc_id = kinds.least),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared from terms a join terms b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from pairs join kinds x on x.least = a join kinds y on y.least = b where 100 * shared >= 75 * (x.n + y.n - shared)),
both_ways as (select a, b from links union all select b, a from links),
reach(node, spot) as (select least, least from kinds union select reach.node, both_ways.b from reach join both_ways on both_ways.a = reach.spot),
found as (select node, min(spot) as component from reach group by node)
select documents.doc_id, cast(coalesce(sized.n, 0) as bigint) as n_shingles, coalesce(found.component, documents.doc_id) as component_id, coalesce(found.component, documents.doc_id) = documents.doc_id as kept
from documents left join sized using (doc_id) left join kinds using (same) left join found on found.node = kinds.least"""


def url_rules_sql() -> str:
    rules = ", ".join(f"({tier}, {quoted(verdict)}, {quoted(rule)}, {quoted(rule.partition('/')[0])}, {quoted(rule[len(rule.partition('/')[0]):])})" for tier, many in enumerate((url_rules.RULES, url_rules.OWN_RULES)) for verdict, rule in many)
    words = ", ".join(map(quoted, url_rules.WORDS))
    return rf"""
with rules(tier, verdict, rule, rule_host, rule_path) as (values {rules}),
rest as (select page_id, row_number() over () as n, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (select page_id, n, translate(regexp_extract(rest, '^[^/?#]*'), '{url_rules.UPPER}', '{url_rules.LOWER}') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from rest),
best as (
  select n, arg_max(struct_pack(tier := tier, rule := rule, verdict := verdict), struct_pack(a := -tier, b := length(rule), c := length(rule_host), d := rule, e := verdict)) as r
  from parts join rules on host <> '' and (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path) group by n)
select page_id, host, path, case when r.tier = 0 then r.rule end as rule,
  coalesce(r.verdict, case when list_has_any(regexp_split_to_array(host, '[._-]'), [{words}]) then 'block' else 'allow' end) as verdict, case when r.tier > 0 then r.rule end as own_rule
from parts left join best using (n)"""


def phrases_sql() -> str:
    return rf"""
with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), '{url_rules.UPPER}', '{url_rules.LOWER}') as t from documents),
pieces as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as p from d)),
sizes as (select lang, cast(sum(len(w)) as bigint) as n from pieces group by lang),
grams as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from pieces, range(1, {phrases.LONGEST + 1}) t(k) where len(w) >= k)),
f as (select lang, k, phrase, string_split(phrase, ' ') as ws, count(*) as f from grams group by lang, k, phrase having count(*) >= {phrases.LEAST}),
parts as (select lang, phrase, k, f as a, ws, unnest(range(1, k)) as cut from f where k > 1),
cuts as (
  select c.lang, c.phrase, a, cut, x.f as l, y.f as r, n, x.phrase as first, y.phrase as rest, x.k as first_k, y.k as rest_k, (1000::hugeint * a * n) // (x.f::hugeint * y.f) as score
  from parts c join f x on x.lang = c.lang and x.phrase = array_to_string(c.ws[1:cut], ' ') join f y on y.lang = c.lang and y.phrase = array_to_string(c.ws[cut + 1:], ' ') join sizes s on s.lang = c.lang),
held as (select lang, first as phrase from cuts where first_k > 1 and 100 * a >= {phrases.SHARE} * l union select lang, rest from cuts where rest_k > 1 and 100 * a >= {phrases.SHARE} * r),
weakest as (select *, row_number() over (partition by lang, phrase order by score, cut) as nth from cuts),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from weakest anti join held using (lang, phrase) where nth = 1)
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, n, cast(score as bigint) as score from ranked where rank <= {phrases.TOP}"""


def conversation_trie_sql() -> str:
    return f"""
with crcs as (select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: case when (a & 1) = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as t),
ids as (select distinct conv_id from conversations where conv_id is not null),
heads as (select conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 4 as h from ids, crcs),
said as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
turns as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as pos from said),
put as (
  select heads.conv_id, 0 as own, pos, role, text from heads join turns on turns.conv_id = heads.conv_id - heads.conv_id % 20 and pos <= h union all
  select conv_id, 1, pos, role, text from heads join turns using (conv_id) where pos > h),
spots as (select conv_id, row_number() over (partition by conv_id order by own, pos) as d, md5(length(role) || ':' || role || text) as label, len(regexp_extract_all(text, '{WORD}')) as words from put),
running as (select conv_id, d, words, string_agg(label, '') over (partition by conv_id order by d) as prefix from spots union all select conv_id, 0, 0, '' from ids),
steps as (select conv_id, d, words, md5(prefix) as prefix, lag(md5(prefix)) over (partition by conv_id order by d) as parent from running),
nodes as (select prefix, any_value(d) as d, any_value(words) as words, any_value(parent) as parent, min(conv_id) as least, count(*) as n from steps group by prefix),
below as (select parent as prefix, count(*) as children from nodes where parent is not null group by parent),
own as (select nodes.*, coalesce(children, 0) as children from nodes left join below using (prefix)),
sums as (select steps.prefix, sum((n - 1) * own.words) as saved, count(*) filter (children = 0) as leaves from own join steps on steps.conv_id = own.least and steps.d <= own.d group by steps.prefix),
lasts as (select conv_id, arg_max(prefix, d) as prefix from steps group by conv_id),
ends as (select prefix, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends from lasts group by prefix)
select own.least as conv_id, cast(own.d as bigint) as depth, up.least as parent_conv_id, cast(own.n as bigint) as n_convs, cast(own.children as bigint) as n_children, cast(leaves as bigint) as n_leaves, cast(saved as bigint) as saved_tokens,
  coalesce(ends, sha256('')) as ends_sha256
from own join sums using (prefix) left join ends using (prefix) left join nodes up on up.prefix = own.parent"""


ORACLE_SQL = {
    "op3_line_rules": line_rules_sql(),
    "op7_license_scan": licenses_sql(),
    "op8_mix_sources": mixing_sql(),
    "op9_near_duplicates": near_duplicates_sql(),
    "op11_phrases": phrases_sql(),
    "op12_conversation_trie": conversation_trie_sql(),
    "op13_url_rules": url_rules_sql(),
}
