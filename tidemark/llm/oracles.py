"""SQL (DuckDB) for the queries that SQL can express: the join, the search and the quality rules."""

from __future__ import annotations

from tidemark.llm.quality import RULES

WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

JACCARD = rf"""with recursive w as (select doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end s from w),
each as (select doc_id, len(s) n, unnest(s) h from s),
met as (select a.doc_id u, b.doc_id v, a.n nu, b.n nv, count(*) c from each a join each b on a.h = b.h and a.doc_id <> b.doc_id group by all),
links as (select u, v from met where 100 * c >= 75 * (nu + nv - c)),
reach as (select doc_id a, doc_id b from documents union select a, v from reach join links on b = u),
least as (select a doc_id, min(b) component_id from reach group by 1)
select s.doc_id, len(s)::bigint n_shingles, component_id from s join least on s.doc_id = least.doc_id"""

SEARCH = """with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) v from embeddings where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
r as (select q.vec_id query_id, v.vec_id, list_dot_product(q.v, v.v)::bigint score from v q join v on q.vec_id <> v.vec_id where q.vec_id % 50 = 0),
n as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from r)
select query_id, rank, vec_id, score from n where rank <= 5"""


def quality(alpha: float = 0.02, delta: float = 0.05, price: float = 20.0) -> str:
    """Counts, calibration with exact binomial tails, and verdicts."""
    firsts, tests, earlier = [], [], "false"
    for name, (_, cuts) in RULES.items():
        firsts.append(f"count(*) filter (quality = 0 and {name} > {cuts[-1]} and not ({earlier})) first_{name}")
        earlier += f" or {name} > {cuts[-1]}"
        tests += [f"select '{name}' as rule, {c}::double cut, stratum, count(*) filter (quality = 1 and {name} > {c}) k, count(*) filter (quality = 0 and {name} > {c}) bad from known group by stratum" for c in cuts]
    caught = " + ".join(f"first_{n}" for n in RULES)
    part = " ".join(f"when '{n}' then first_{n}" for n in RULES)
    over = " or ".join(f"coalesce({n} > (select cut from best where best.rule = '{n}' and best.stratum is not distinct from r.lang), false)" for n in RULES)
    return rf"""with t as (select doc_id, lang, coalesce(text, '') t from documents),
l as (select *, {WORDS.format("t")} w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ls from t),
x as (select doc_id, unnest(range(1, len(w) - 6)) i, w from l where len(w) > 8),
y as (select doc_id, i, array_to_string(w[i:i + 7], ' ') h from x),
z as (select doc_id, i, count(*) over (partition by doc_id, h) c from y),
g as (select doc_id, least(8, coalesce(lead(i) over (partition by doc_id order by i) - i, 8)) n from z where c > 1),
rep as (select doc_id, sum(n)::bigint n from g group by 1),
m as (select l.doc_id, lang, len(w)::bigint n_words, length(array_to_string(w, ''))::bigint word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, (len(ls) - len(list_distinct(ls)))::bigint n_dup_lines, coalesce(rep.n, 0)::bigint n_repeat_words,
 len(ls) n_lines, length(t) - length(replace(t, '!', '')) n_exclaims, length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) n_uppers from l left join rep on l.doc_id = rep.doc_id),
r as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words base_failed, {', '.join(f'({e})::double as {n}' for n, (e, _) in RULES.items())} from m),
q as (select doc_id, min(quality) quality from labels where doc_id is not null and quality is not null group by 1),
known as (select r.*, r.lang stratum, quality from r join q on r.doc_id = q.doc_id where not base_failed),
st as (select stratum, count(*) filter (quality = 1) good, {', '.join(firsts)} from known group by stratum),
cuts as ({' union all '.join(tests)}),
tried as (select cuts.*, good, case rule {part} end / nullif({caught}, 0) part, (select greatest(count(*), 1) from st) strata from cuts join st on cuts.stratum is not distinct from st.stratum),
safe as (select * from tried where part > 0 and k < {alpha} * part * good and bad > {price} * k
 and ln(list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) + i * ln({alpha} * part) + (good - i) * ln(1 - {alpha} * part))))) <= ln({delta} * part / strata)),
best as (select rule, stratum, arg_max(cut, (bad - {price} * k) * 1000 + cut) cut from safe group by 1, 2)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not (base_failed or {over}) kept from r"""


def oracle_sql() -> dict[str, str]:
    return {"op3_jaccard": JACCARD, "op7_search": SEARCH, "op10_quality": quality()}
