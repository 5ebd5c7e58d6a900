"""DuckDB SQL for the text queries that SQL can express.

Constants are written out; nothing is taken from the operators.
"""

from __future__ import annotations

BLANK = "[\\x20\\x09-\\x0D]"
WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{BLANK}+'), lambda w: w <> '')"


def _op3() -> str:
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    letters = " || ".join(
        f"substr('{alphabet}', 1 + ((('0x' || substr(h, {5 * i + 1}, 5))::bigint // {32 ** (3 - k)}) % 32)::int, 1)"
        for i in range(8)
        for k in range(4)
    )
    return f"""
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
d as (select page_id, html, strlen(html)::bigint as payload_bytes, {letters} as payload_digest from p),
f as (select *, min(page_id) over (partition by html) as first from d)
select page_id, payload_bytes, payload_digest, if(page_id = first, 'response', 'revisit') as record_type,
       if(page_id = first, null, first) as refers_to
from f"""


def _op4() -> str:
    margins = {"source": 0.5, "lang": 0.7, "topic": 0.7}
    steps = ["w0 as (select source, lang, topic, n_words, n_words::double as weight from cells)"]
    for margin, power in margins.items():
        steps.append(f"g_{margin} as (select {margin}, pow(sum(n_words), {power}::double) as part from cells group by 1)")
        steps.append(
            f"t_{margin} as (select {margin}, part / (select sum(part) from g_{margin}) * (select sum(n_words) from cells) as target "
            f"from g_{margin} where part > 0)"
        )
    k = 0
    for _ in range(8):
        for margin in margins:
            steps.append(f"n{k} as (select {margin}, sum(weight) as now from w{k} group by 1)")
            steps.append(
                f"w{k + 1} as materialized (select source, lang, topic, n_words, weight * coalesce(target / nullif(now, 0), 1.0::double) as weight "
                f"from w{k} join n{k} using ({margin}) left join t_{margin} using ({margin}))"
            )
            k += 1
    steps.append("s0 as (select 0.6::double as scale)")
    for i in range(12):
        steps.append(
            f"s{i + 1} as materialized (select any_value(scale) * (sum(n_words) * 0.6::double) / sum(least(n_words::double, scale * weight)) as scale "
            f"from w{k}, s{i})"
        )
    return f"""
with d as (
  select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang, coalesce(text, '') as t, len({WORDS})::bigint as n_words
  from documents),
m as (select doc_id, source, lang, n_words,
        case when (length(t) - length(replace(t, '|', ''))) * 20 > n_words then 'table'
             when (length(t) - length(replace(t, chr(10), ''))) * 10 > n_words then 'list' else 'prose' end as topic
      from d),
cells as materialized (select source, lang, topic, sum(n_words)::bigint as n_words from m group by all),
{", ".join(steps)},
p as (select source, lang, topic, round(if(n_words > 0, least(1.0::double, scale * weight / n_words), 1.0::double), 9) as probability
      from w{k}, s12)
select doc_id, source, lang, topic, n_words, probability,
       ('0x' || substr(md5(doc_id || ':7'), 1, 13))::bigint / 4503599627370496.0::double < probability as kept
from m join p using (source, lang, topic)"""


def _op5() -> str:
    ratios = {
        "symbol_ratio": ("n_symbols", "n_words", 100, 400),
        "dup_line_ratio": ("n_dup_lines", "n_lines", 100, 100),
        "repeat_ratio": ("n_repeat_words", "n_words", 100, 100),
        "word_length": ("word_chars", "n_words", 2, 100),
    }
    values = " union all ".join(
        f"select doc_id, coalesce(lang, '') as stratum, base_failed, '{name}' as ratio, {last} as last, {step} as step, "
        f"least(greatest(ceil(if({b} > 0, {a}::double / {b}::double, 0::double) * {step}), 1), {last} + 1)::bigint as point from c"
        for name, (a, b, step, last) in ratios.items()
    )
    # P(X <= k) for X binomial(n, 0.01), summed from logarithms.
    term = "exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01::double) + (n - i) * ln(0.99::double))"
    return f"""
with d as materialized (
  select doc_id, lang, coalesce(text, '') as t, {WORDS} as w from documents),
tri as (
  select doc_id, j, w[j:j + 2] as g from (select doc_id, w, unnest(range(1, len(w) - 1)) as j from d)),
twice as (select doc_id, j from (select doc_id, j, count(*) over (partition by doc_id, g) as n from tri) where n > 1),
repeats as (select doc_id, count(distinct j + k) as n from twice, range(3) as r(k) group by 1),
c as materialized (
  select doc_id, lang, len(w)::bigint as n_words,
    length(regexp_replace(t, '{BLANK}+', '', 'g'))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, len(l)::bigint as n_lines,
    coalesce(n, 0)::bigint as n_repeat_words,
    len(w) < 50 or 100 * coalesce(n, 0) > 50 * len(w) as base_failed
  from (select *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from d)
  left join repeats using (doc_id)),
v as materialized ({values}),
good as (select doc_id from labels where quality is not null group by 1 having min(quality) = 1),
h as materialized (select stratum, ratio, last, step, point, count(*) as n from v join good using (doc_id) where not base_failed group by all),
tests as (select count(*) as m from (select distinct stratum, ratio from h)),
s as (select stratum, ratio, last, step, sum(n) as n from h group by all),
cdf as (select n, i, sum({term}) over (partition by n order by i) as f
        from (select distinct n from s), lateral (select unnest(range(0, (n * 0.01)::bigint + 2)) as i)),
allowed as (select n, max(i) as k from cdf, tests where f <= 0.05::double / m group by 1),
cut as (
  select stratum, ratio, min(g) as cutoff from (
    select s.stratum, s.ratio, g, k, coalesce(sum(h.n) filter (h.point > g), 0) as rejected
    from s join allowed using (n), lateral (select unnest(range(1, s.last + 1)) as g)
    join h on h.stratum = s.stratum and h.ratio = s.ratio group by all)
  where rejected <= k group by 1, 2),
bad as (select distinct doc_id from v join cut using (stratum, ratio) where point > cutoff)
select c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and bad.doc_id is null as kept
from c left join bad using (doc_id)"""


def _op6() -> str:
    # Lines one edit apart share the first or the last half, by the length of the shorter one.
    return """
with l as materialized (
  select doc_id, no, ls[no] as line from (
    select doc_id, ls, unnest(range(1, len(ls) + 1)) as no from (select doc_id, string_split(text, chr(10)) as ls from documents))),
o as materialized (
  select *, row_number() over (partition by line order by doc_id, no) as nth from l where regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
f as materialized (select doc_id, no, line, length(line) as n from o where nth = 1 and length(line) >= 20),
k as materialized (
  select f.*, m, side, if(side = 0, left(line, m // 2), right(line, m - m // 2)) as part
  from f, (select unnest([0, 1]) as side), lateral (select unnest([n, n - 1]) as m)),
near as (
  select distinct b.doc_id, b.no from k a join k b on a.m = b.m and a.side = b.side and a.part = b.part
  where (a.doc_id, a.no) < (b.doc_id, b.no) and levenshtein(a.line, b.line) = 1),
gone as (select doc_id, no from o where nth > 1 union select doc_id, no from near),
left_over as (
  select l.doc_id, string_agg(l.line, chr(10) order by l.no) as text from l left join gone g using (doc_id, no) where g.no is null group by 1),
n as (select doc_id, count(*) as n from o group by 1),
r as (select doc_id, count(*) as n from gone group by 1)
select d.doc_id, coalesce(n.n, 0)::bigint as n_lines, coalesce(r.n, 0)::bigint as n_removed, sha256(coalesce(t.text, '')) as kept_sha256
from documents d left join left_over t using (doc_id) left join n using (doc_id) left join r using (doc_id)"""


def _op10() -> str:
    return f"""
with recursive w as materialized (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{BLANK}+'), lambda x: x <> '') as w
  from documents),
s as materialized (
  select distinct doc_id, g from (
    select doc_id, w[j:j + 4] as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as j from w where len(w) > 0))),
n as materialized (select doc_id, count(*) as n from s group by 1),
pair as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
e as materialized (
  select a, b from pair join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
r as (select doc_id as a, doc_id as b from documents union select r.a, e.b from r join e on r.b = e.a),
m as (select a as doc_id, min(b) as component_id from r group by 1)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
from documents left join n using (doc_id) join m using (doc_id)"""


def _op11() -> str:
    return """
with v as materialized (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as materialized (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
p as (
  select anchor_id, other_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, other_id)::int as rank,
       other_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3"""


def _op12() -> str:
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    terms = f"regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
with d as materialized (select doc_id, {terms} as w from documents where len({terms}) > 0),
q as materialized (select item_id, unnest({terms}) as term from benchmark),
total as materialized (select count(*) as n_docs, sum(len(w))::bigint as l from d),
tf as materialized (
  select doc_id, n, term, count(*) as tf from (select doc_id, len(w) as n, unnest(w) as term from d)
  where term in (select term from q) group by all),
weights as materialized (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)))::bigint as w
  from (select term, count(*) as df from tf group by 1), total),
part as (
  select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // l))) as s
  from tf join weights using (term), total),
scored as (select item_id, doc_id, sum(s)::bigint as score from q join part using (term) group by 1, 2)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from scored where score > 0 qualify rank <= 10"""


def _op13() -> str:
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    listed = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)

    def pieces(part: str, sep: str) -> str:
        kept = f"list_filter(regexp_split_to_array({part}, '{sep}'), lambda t: t <> '')"
        return f"list_transform({kept}, lambda t: '{part[0]}:' || regexp_replace(t, '([0-9])[0-9]*', '\\1#', 'g'))"

    each = " || ".join(pieces(p, s) for p, s in (("host", "[.:@-]+"), ("path", "[/._-]+"), ("query", "&+"), ("fragment", "#+")))
    # All sets of a url's tokens, by the bits of a number; those of labelled urls that are frequent are the rules.
    subset = "list_sort(list_filter(tokens, lambda t, i: (m >> (i - 1)::int) & 1 = 1))"
    return f"""
with s as (
  select page_id, case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as materialized (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1) as query,
         regexp_extract(rest, '(?s)^[^#]*#(.*)', 1) as fragment
  from s),
rules as (select * from (values {listed}) r(verdict, rule_host, rule_path)),
fits as (
  select page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule, arg_max(verdict, length(rule_host || rule_path)) as given
  from p join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path) group by 1),
t as materialized (select page_id, host, path, rule, given, list_distinct({each}) as tokens from p left join fits using (page_id)),
sets as materialized (
  select page_id, given, {subset} as items from (select page_id, given, tokens, unnest(range(1, 1 << len(tokens))) as m from t)),
least as (select ceil(0.01::double * count(*)) as least from t where given is not null),
freq as (select items, count(*) as n from sets where given is not null group by 1),
found as materialized (
  select items, given as verdict, count(*) as support, count(*)::double / any_value(n) as confidence
  from sets join freq using (items) where given is not null group by 1, 2
  having count(*) >= (select least from least) and count(*)::double / any_value(n) >= 0.7::double),
best as (
  select page_id, max({{'c': confidence, 's': support, 'b': verdict = 'block', 'v': verdict}}) as best
  from sets join found using (items) where given is null group by 1)
select page_id, host, path, rule, coalesce(given, best.v, 'allow') as verdict, best.v as learned, coalesce(best.s, 0)::bigint as support, coalesce(best.c, 0) as confidence
from t left join best using (page_id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc": _op3(),
        "op4_mixing": _op4(),
        "op5_quality_rules": _op5(),
        "op6_line_dedup": _op6(),
        "op10_near_duplicates": _op10(),
        "op11_hard_negatives": _op11(),
        "op12_search": _op12(),
        "op13_url_filter": _op13(),
    }
