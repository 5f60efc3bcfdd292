"""DuckDB SQL for the corpus queries that SQL can state, written from the
contracts and not from the operators: brute force by joins and windows, for
small tables."""

from __future__ import annotations

BLANK = r"[\x20\x09-\x0D]+"
LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

EXACT_DEDUP = rf"""
select doc_id, first_value(doc_id) over same as keep_id, count(*) over (partition by body) as group_size,
 row_number() over same = 1 as kept, sha256(body) as text_sha256
 from (select doc_id, regexp_replace(coalesce(text, ''), '{BLANK}', ' ', 'g') as body from documents)
 window same as (partition by body order by doc_id nulls last)"""

LINE_DEDUP = f"""
with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
line as (
 select doc_id, i, lines[i] as raw, translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {LOWER}) as bare
 from split, unnest(range(1, len(lines) + 1)) as t(i)),
gone as (select bare, max(doc_id) as home from line where length(bare) >= 40 group by bare having count(distinct doc_id) >= 5),
judged as (select l.*, g.bare is not null and l.doc_id <> g.home as drops from line l left join gone g using (bare))
select doc_id, count(*) as n_lines, count(*) filter (drops) as n_dropped,
 sha256(coalesce(string_agg(raw, chr(10) order by i) filter (not drops), '')) as kept_sha256 from judged group by doc_id"""

FILTER_AUDIT = rf"""
with word as (
 select doc_id, coalesce(lang, '') as part, coalesce(text, '') as body,
  list_filter(string_split_regex(coalesce(text, ''), '{BLANK}'), lambda w: w <> '') as words from documents),
failed as (
 select doc_id, part, (len(words) < 100)::int + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::int
  + 4 * (100 * len(regexp_extract_all(body, '[A-Z]')) > 10 * length(body))::int + 8 * regexp_matches(body, '[#$%&*|]')::int
  + 16 * (doc_id > min(doc_id) over (partition by body))::int as mask from word),
rated as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
cell as (
 select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from failed left join rated using (doc_id) group by part, mask),
letter as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
orders as (
 select a.f || b.f || c.f || d.f || e.f as o from letter a, letter b, letter c, letter d, letter e
  where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
step as (
 select o, s, 1 << (ascii(o[s]) - 65) as bit, list_sum(list_transform(range(1, s), lambda j: 1 << (ascii(o[j]) - 65)))::int as earlier
  from orders, unnest(range(1, 6)) as t(s)),
counted as (
 select part, o, s, bit,
  sum(n) filter (mask & (coalesce(earlier, 0) | bit) = 0) as kept, sum(n) filter (mask & bit > 0 and mask & coalesce(earlier, 0) = 0) as removed,
  sum(n) filter (mask & bit > 0 and mask & coalesce(earlier, 0) > 0) as redundant, sum(n) filter (mask = bit) as unique_fails,
  sum(good) filter (mask & bit > 0 and mask & coalesce(earlier, 0) = 0) as good_lost,
  sum(toxic) filter (mask & bit > 0 and mask & coalesce(earlier, 0) = 0) as toxic_lost
  from cell, step group by part, o, s, bit)
select part, o as filter_order, s::int as step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
 coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost,
 coalesce(toxic_lost, 0)::bigint as toxic_lost, coalesce(sum(removed) over (partition by part, bit), 0)::bigint as shapley from counted"""

JACCARD = rf"""
with recursive word as materialized (
 select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {LOWER}), '{BLANK}'), lambda w: w <> '') as words from documents),
shingles as materialized (
 select doc_id, case when len(words) = 0 then [] when len(words) < 3 then [array_to_string(words, ' ')]
  else list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) end as s from word),
sets as materialized (select min(doc_id) as node, list_sort(s) as s from shingles where len(s) > 0 group by list_sort(s)),
one as materialized (select node, unnest(s) as x, len(s) as n from sets),
pair as materialized (
 select a.node as a, b.node as b from one a join one b on a.x = b.x and a.node < b.node
  group by a.node, b.node, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
edge as materialized (select a, b from pair union all select b, a from pair),
reach(node, root) as (select node, node from sets union select e.b, r.root from reach r join edge e on e.a = r.node),
least_root as (select node, min(root) as root from reach group by node)
select h.doc_id, len(h.s)::bigint as n_shingles, coalesce(r.root, h.doc_id) as component_id
 from shingles h left join sets g on len(h.s) > 0 and g.s = list_sort(h.s) left join least_root r using (node)"""

_PARTS, _ENTRIES, _ROUNDS = 8, 16, 6


def equal_average() -> str:
    """The rounds one after another: every part against every entry."""
    ctes = [f"""kept as materialized (
 select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
part as materialized (
 select vec_id, label, p, list_slice(v, p * len(v) // {_PARTS} + 1, (p + 1) * len(v) // {_PARTS}) as x from kept, unnest(range({_PARTS})) as t(p)),
book0 as materialized (
 select p, e, x as c from part join (select vec_id, row_number() over (order by vec_id) - 1 as e from kept order by vec_id limit {_ENTRIES}) using (vec_id))"""]
    for r in range(_ROUNDS + 1):
        ctes.append(f"""near{r} as materialized (
 select vec_id, label, p, x, arg_min((e, away), (away, e)) as best from (
  select a.vec_id, a.label, a.p, a.x, b.e, list_sum(list_transform(list_zip(a.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as away
   from part a join book{r} b using (p)) group by vec_id, label, p, x)""")
        if r < _ROUNDS:
            ctes.append(f"""moved{r} as materialized (
 select p, e, list(floor_mean order by i) as c from (
  select p, best[1] as e, i, (sum(x[i])::bigint - ((sum(x[i])::bigint % count(*)) + count(*)) % count(*)) // count(*) as floor_mean
   from near{r}, unnest(range(1, len(x) + 1)) as t(i) group by p, best[1], i) group by p, e),
book{r + 1} as materialized (select b.p, b.e, coalesce(m.c, b.c) as c from book{r} b left join moved{r} m on m.p = b.p and m.e = b.e)""")
    return "with " + ",\n".join(ctes) + f""",
coded as (
 select vec_id, label, string_agg(lpad(printf('%x', best[1]), 2, '0'), '' order by p) as code, sum(best[2])::bigint as error from near{_ROUNDS} group by vec_id, label)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
 (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) from book{_ROUNDS}) as codebooks_sha256 from coded"""


_RISK, _ERROR, _PRICE = 0.02, 0.05, 20
RISK_RULES = rf"""
with body as (
 select doc_id, lang as stratum, coalesce(text, '') as t, list_filter(string_split_regex(coalesce(text, ''), '{BLANK}'), lambda w: w <> '') as w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as l from documents),
again as (
 select doc_id, count(distinct i + j) as n from (
  select doc_id, i, count(*) over (partition by doc_id, five) as found from (
   select doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') as five from body, unnest(range(1, len(w) - 3)) as t(i)))
  , unnest(range(5)) as u(j) where found > 1 group by doc_id),
counted as (
 select b.doc_id, stratum, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, len(l) as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
  coalesce(a.n, 0)::bigint as n_repeat_words from body b left join again a using (doc_id)),
rows as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counted),
score as (
 select doc_id, stratum, base_failed, unnest([{{'s': 'symbols', 'v': coalesce(n_symbols / nullif(word_chars, 0), 0)}},
  {{'s': 'lines', 'v': coalesce(n_dup_lines / nullif(n_lines, 0), 0)}}, {{'s': 'repeats', 'v': coalesce(n_repeat_words / nullif(n_words, 0), 0)}}], recursive := true)
  from rows),
marked as (select doc_id, min(quality) = 1 as good from labels where quality is not null group by doc_id having doc_id is not null),
held as (select stratum, good, s, least(ceil(round(v * 100, 9)), 100)::int as step from score join marked using (doc_id) where not base_failed),
strata as (select stratum, count(*) // 3 as n from held where good group by stratum),
home as (
 select stratum, if(n < ceil(ln({_ERROR} / (3 * (many + 1))) / ln(1 - {_RISK})), 'the pool', 'of ' || coalesce(stratum, '')) as g
  from strata, (select count(*) as many from strata)),
ladder as (select g, s, good, step from held join home on held.stratum is not distinct from home.stratum),
tried as (
 select g, s, x as step, count(*) filter (good) as n, count(*) filter (good and step > x) as k, count(*) filter (not good and step > x) as bad
  from ladder, unnest(range(100)) as t(x) group by g, s, x),
proved as (
 select *, k <= n * {_RISK} and list_sum(list_transform(range(least(k, 9999) + 1),
   lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RISK}) + (n - i) * ln(1 - {_RISK})))) <= {_ERROR} / (3 * (select count(distinct g) from tried)) as ok
  from tried where n > 0),
safe as (select * from (select *, bool_and(ok) over (partition by g, s order by step desc) as held from proved) where held),
chosen as (select g, s, arg_max(step, (bad - {_PRICE} * k, step)) / 100 as cutoff from safe group by g, s),
cut as (
 select stratum, max(cutoff) filter (s = 'symbols') as symbols_cutoff, max(cutoff) filter (s = 'lines') as lines_cutoff,
  max(cutoff) filter (s = 'repeats') as repeats_cutoff from home join chosen using (g) group by stratum)
select r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 not base_failed and not coalesce(n_symbols / nullif(word_chars, 0) > symbols_cutoff, false)
  and not coalesce(n_dup_lines / nullif(n_lines, 0) > lines_cutoff, false) and not coalesce(n_repeat_words / nullif(n_words, 0) > repeats_cutoff, false) as kept,
 r.stratum, symbols_cutoff, lines_cutoff, repeats_cutoff from rows r left join cut c on c.stratum is not distinct from r.stratum"""


ORACLE = {
    "op6_risk_rules": RISK_RULES,
    "op7_parity_join": JACCARD,
    "op9_exact_dedup": EXACT_DEDUP,
    "op11_equal_average": equal_average(),
    "op12_line_dedup": LINE_DEDUP,
    "op13_filter_audit": FILTER_AUDIT,
}
