"""DuckDB SQL for the registered queries that SQL can express.

None for op1, op3 (learned models, a tokenizer's merges), op7 (bounded-error
matching), op11 (eigenvectors) and op13 (a hash that DuckDB lacks): ``tests/llm`` holds
those against brute force.
"""

from __future__ import annotations

from shelfwise.llm.secret_scan import BASE_RULES, RULES, Rule

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALNUM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WHITE_WORDS = r"[^\x20\x09-\x0D]+"


def _low(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"


SUFFIX_DEDUP = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents),
 s as (select doc_id, unnest(generate_series(0, n - 50)) as p, h from d where n >= 50),
 g as (select doc_id, p, substr(h, 2 * p + 1, 100) as w from s),
 f as (select w, min(doc_id) as least from g group by w),
 m as (select doc_id, p from g join f using (w) where least < doc_id),
 e as (select doc_id, p, lag(p) over (partition by doc_id order by p) as q from m),
 r as (select doc_id, p, sum(case when q is null or p > q + 50 then 1 else 0 end) over (partition by doc_id order by p) as k from e),
 u as (select doc_id, k, min(p) as a, max(p) + 50 as b from r group by doc_id, k),
 t as (select doc_id, a, b, lag(b, 1, 0) over (partition by doc_id order by a) as before from u),
 v as (select doc_id, count(*) as n_spans, sum(b - a)::bigint as n_removed, max(b) as final,
   string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) as head
   from t join d using (doc_id) group by doc_id)
select doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(head || substr(h, 2 * final + 1), h))) as kept_sha256
from d left join v using (doc_id)
"""

_WORDS = f"regexp_extract_all(coalesce(text, ''), '{WHITE_WORDS}')"
_LIMITS = """quantile_disc(symbol_rate, 0.25) as symbol_rate_low, quantile_disc(symbol_rate, 0.75) as symbol_rate_high,
   quantile_disc(repeat_rate, 0.875) as repeat_rate_low, quantile_disc(repeat_rate, 0.984375) as repeat_rate_high,
   quantile_disc(dup_line_rate, 0.875) as dup_line_rate_low, quantile_disc(dup_line_rate, 0.984375) as dup_line_rate_high,
   quantile_disc(word_length, 0.25) as word_length_low, quantile_disc(word_length, 0.75) as word_length_high"""


def _bound(rate: str, which: str) -> str:
    return f"case when g.n >= 100 then g.{rate}_{which} when l.n >= 100 then l.{rate}_{which} end"


def _most(rate: str, spreads: int, slack: int) -> str:
    high, low = _bound(rate, "high"), _bound(rate, "low")
    return f"coalesce({rate} <= {high} + {spreads} * ({high} - {low}) + {slack}, true)"


_WITHIN = " and ".join(
    [_most("symbol_rate", 3, 300), _most("repeat_rate", 2, 100), _most("dup_line_rate", 2, 100), _most("word_length", 3, 150),
     f"coalesce(word_length >= {_bound('word_length', 'low')} - 3 * ({_bound('word_length', 'high')} - {_bound('word_length', 'low')}) - 150, true)"]
)

QUALITY_RULES = f"""
with d as (select doc_id, lang, source, coalesce(text, '') as text, {_WORDS} as w,
   [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as lines from documents),
 p as (select doc_id, unnest(range(0, len(w) - 4)) as i, w from d where len(w) >= 5),
 h as (select doc_id, i, w[i + 1:i + 5] as win from p),
 c as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, win) as k from h) where k > 1),
 r as (select doc_id, count(distinct i + k)::bigint as n_repeat_words from c, (select unnest([0, 1, 2, 3, 4]) as k) group by doc_id),
 s as (select doc_id, lang, source, len(w)::bigint as n_words,
   coalesce(list_sum([length(x) for x in w]), 0)::bigint as word_chars,
   len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, len(lines) as n_lines,
   (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
   from d left join r using (doc_id)),
 t as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
   10000 * n_symbols // greatest(word_chars, 1) as symbol_rate, 10000 * n_repeat_words // greatest(n_words, 1) as repeat_rate,
   10000 * n_dup_lines // greatest(n_lines, 1) as dup_line_rate, 100 * word_chars // greatest(n_words, 1) as word_length from s),
 g as (select lang, source, count(*) as n, {_LIMITS} from t where not base_failed group by lang, source),
 l as (select lang, count(*) as n, {_LIMITS} from t where not base_failed group by lang)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and {_WITHIN} as kept
from t left join g on t.lang is not distinct from g.lang and t.source is not distinct from g.source
  left join l on t.lang is not distinct from l.lang
"""

URL_FILTER = f"""
with u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
 p as (select page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') as host,
   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
 r(rule_host, rule_path, rule_verdict) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
   ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
 m as (select page_id, rule_host || rule_path as rule, rule_verdict,
   row_number() over (partition by page_id order by length(rule_host || rule_path) desc, length(rule_host) desc, rule_verdict desc) as k
   from p join r on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select p.page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict
from p left join m on p.page_id = m.page_id and k = 1
"""

JACCARD_JOIN = f"""
with recursive d as (select doc_id, regexp_extract_all({_low('text')}, '{WHITE_WORDS}') as w from documents),
 i as (select doc_id, unnest(range(0, len(w) - 2)) as i, w from d where len(w) >= 3),
 s as (select distinct doc_id, array_to_string(w[i + 1:i + 3], ' ') as s from i
   union select doc_id, array_to_string(w, ' ') from d where len(w) between 1 and 2),
 n as (select doc_id, count(*) as n from s group by doc_id),
 p as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.s = b.s and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
 e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 90 * (x.n + y.n - k)),
 c(doc_id, reached) as (select doc_id, doc_id from d union select c.doc_id, e.b from c join e on e.a = c.reached)
select d.doc_id, coalesce(n.n, 0) as n_shingles, min(reached) as component_id
from d left join n using (doc_id) join c using (doc_id) group by d.doc_id, n.n
"""

DECONTAMINATE = f"""
with d as (select doc_id, regexp_extract_all({_low('text')}, '{ALNUM_WORDS}') as w from documents),
 b as (select item_id, regexp_extract_all({_low('text')}, '{ALNUM_WORDS}') as w from benchmark),
 q as (select item_id, unnest(range(0, greatest(len(w) - 9, 1))) as i, least(len(w), 10) as m, w from b where len(w) > 0),
 z as (select distinct item_id, m, array_to_string(w[i + 1:i + m], ' ') as win from q),
 k as (select distinct m from z),
 o as (select doc_id, m, unnest(range(0, len(w) - m + 1)) as i, w from d, k where len(w) >= m),
 v as (select doc_id, m, i, array_to_string(w[i + 1:i + m], ' ') as win from o),
 f as (select doc_id, m, i, item_id from v join z using (m, win)),
 t as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + m)) as j from f) group by doc_id),
 g as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
   from (select distinct doc_id, cast(item_id as varchar) as item_id from f) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join t using (doc_id) left join g using (doc_id)
"""

_LINES = """select doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) as place,
   unnest(string_split(text, chr(10))) as line from documents"""

LINE_DEDUP = f"""
with l as ({_LINES}),
 b as (select line, min(doc_id) as home from l where regexp_matches(line, '[^\\x20\\x09-\\x0D]')
   group by line having count(distinct source) >= 5),
 k as (select l.*, home, row_number() over (partition by doc_id, l.line order by place) as turn from l left join b on l.line = b.line),
 s as (select *, home is not null and not (home = doc_id and turn = 1) as gone from k),
 t as (select doc_id, count(*) as n_lines, count(*) filter (gone) as n_removed,
   coalesce(string_agg(line, chr(10) order by place) filter (not gone), '') as kept from s group by doc_id)
select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, case when text is not null then sha256(kept) end as kept_sha256
from documents left join t using (doc_id)
"""


def _rule(rule: Rule, number: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    found = ", ".join(f"regexp_extract_all(coalesce(text, ''), '{p}', {g})" for p, g in (
        (f"(?s)(.*?)({pattern})", 1), (f"({pattern})", 1), (f"({pattern})", rule.group + 1)))
    return f"""select doc_id, '{rule.kind}' as kind, {number} as number, unnest(range(1, len(w) + 1)) as i, g, w, j
   from (select doc_id, x[1] as g, x[2] as w, x[3] as j from (select doc_id, [{found}] as x from documents)) where len(w) > 0"""


SECRET_SCAN = f"""
with m as ({" union all ".join(_rule(rule, k) for k, rule in enumerate(RULES))}),
 p as (select doc_id, kind, number, list_sum([length(x) for x in g[:i]])::bigint + coalesce(list_sum([length(x) for x in w[:i - 1]]), 0)::bigint as a,
   length(w[i]) as n, length(j[i]) as judged from m),
 l(kind, least) as (values {", ".join(f"('{rule.kind}', {rule.least})" for rule in RULES)}),
 s as (select doc_id, kind, number, a, concat_ws(':', kind, a, a + n) as span from p join l using (kind) where judged >= least),
 t as (select doc_id, {", ".join(f"count(*) filter (kind = '{rule.kind}') as n_{rule.kind}" for rule in BASE_RULES)},
   string_agg(span, ',' order by a, number) filter (number < {len(BASE_RULES)}) as base, string_agg(span, ',' order by a, number) as spans
   from s group by doc_id)
select doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0) as n_{rule.kind}" for rule in BASE_RULES)},
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join t using (doc_id)
"""

FILTER_AUDIT = f"""
with t as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, {_WORDS} as w from documents),
 f as (select doc_id, part, len(w) < 100 as a, 100 * len(list_distinct(w)) < 80 * len(w) as b,
   100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) as c, regexp_matches(text, '[#$%&*|]') as d,
   coalesce(doc_id > min(doc_id) over (partition by text), false) as e from t),
 l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
   from labels group by doc_id),
 m as (select part, [a, b, c, d, e] as fails, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
   from f left join l using (doc_id) group by part, fails),
 x as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
 o as (select p.x || q.x || r.x || s.x || u.x as filter_order from x p, x q, x r, x s, x u
   where p.x not in (q.x, r.x, s.x, u.x) and q.x not in (r.x, s.x, u.x) and r.x not in (s.x, u.x) and s.x <> u.x),
 k as (select m.*, filter_order, list_min([case when fails[i] then strpos(filter_order, chr(64 + i)) else 6 end for i in [1, 2, 3, 4, 5]]) as gone
   from m, o),
 g as (select part, filter_order, cast(step as int) as step, ascii(filter_order[step]) - 64 as number,
   sum(n) filter (gone > step) as kept, sum(n) filter (gone = step) as removed, sum(n) filter (gone < step and fails[number]) as redundant,
   sum(n) filter (fails[number] and len(list_filter(fails, lambda y: y)) = 1) as unique_fails,
   sum(good) filter (gone = step) as good_lost, sum(toxic) filter (gone = step) as toxic_lost
   from k, (select unnest([1, 2, 3, 4, 5]) as step) group by part, filter_order, step)
select part, filter_order, step, {", ".join(f"coalesce({c}, 0)::bigint as {c}" for c in "kept removed redundant unique_fails good_lost toxic_lost".split())},
  coalesce(sum(removed) over (partition by part, number), 0)::bigint as shapley
from g
"""

ORACLE: dict[str, str] = {
    "op2_suffix_dedup": SUFFIX_DEDUP,
    "op4_quality_rules": QUALITY_RULES,
    "op5_line_dedup": LINE_DEDUP,
    "op6_secret_scan": SECRET_SCAN,
    "op8_url_filter": URL_FILTER,
    "op9_jaccard_join": JACCARD_JOIN,
    "op10_decontaminate": DECONTAMINATE,
    "op12_filter_audit": FILTER_AUDIT,
}
