"""Operator 10 [native]: quality rules whose cutoffs are risk-controlled on labelled holdouts.

Every document gets counts of words, symbols, repeated lines and repeated 8-word windows, all by built-in functions
on the row itself (no shuffle). `calibrate` then chooses, for each stratum (a value of `stratum`, null being one) and
each rule, a cutoff above which a document is rejected. Alpha and delta / strata are dealt to the stratum's rules by the
bad documents that each catches first, in the order of RULES at the strictest cutoffs; good documents have no say in
that. A cutoff is safe if the exact binomial (Clopper-Pearson) test at the rule's part of delta / strata rules out that
it rejects the rule's part of alpha or more of the good ones. A rule's cutoffs are nested, tested from mild to strict as
a fixed sequence, so each has the whole level; so with probability 1 - delta no stratum loses more than alpha of its
good documents. Of the safe cutoffs the one is taken that catches most bad documents net of `price` times the good ones
lost, ties to the highest; where none catches any, or the labels are too few to prove anything, the rule is off.

Nulls: a null text has no words (and fails the base rule). A null or repeated doc_id has its row judged all the same;
labels repeated for a document count once, by their worst quality. Empty tables give empty results. Ratios with a
zero denominator are 0. Repeated rows are measured and judged again each. Texts are taken whole, each in one row's
expressions. Of cutoffs that are as good as each other the highest is taken. Other columns come along, whatever their
names, but for those that have the name of a count or verdict, which the result replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import unused

#: Rules: the ratio that is cut, and the cutoffs tried, from mild to strict.
RULES = {
    "symbol_ratio": ("n_symbols / greatest(word_chars, 1)", [0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05]),
    "exclaim_ratio": ("n_exclaims / greatest(n_words, 1)", [1.5, 1.0, 0.8, 0.6, 0.4, 0.25]),
    "upper_ratio": ("n_uppers / greatest(word_chars, 1)", [0.9, 0.8, 0.7, 0.6, 0.5, 0.3]),
    "dup_line_ratio": ("n_dup_lines / greatest(n_lines, 1)", [0.8, 0.6, 0.5, 0.4, 0.3, 0.2]),
    "repeat_ratio": ("n_repeat_words / greatest(n_words, 1)", [0.3, 0.25, 0.2, 0.15, 0.1]),
}
#: Strata up to this many are broadcast to the verdict's join; more are joined by shuffle.
BROADCAST_ROWS = 4096


def measured(docs: DataFrame, *, text_col: str = "text", window: int = 8) -> DataFrame:
    """The rows of docs with the counts; text is whole."""
    t = f"coalesce({text_col}, '')"
    words = f"filter(split({t}, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w != '')"
    lines = f"filter(split({t}, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    w = window
    # One-element arrays bind a value once for the lambda inside, where a plain reference would be worked out per element.
    hashes = f"transform(array(transform(_words, w -> xxhash64(w))), h -> transform(sequence(1, size(h) - {w - 1}), i -> xxhash64(slice(h, i, {w}))))[0]"
    places = (
        "transform(array(array_sort(transform(a, (x, i) -> struct(x as x, i as i)))), s -> array_sort(transform(filter(sequence(0, size(s) - 1),"
        " k -> coalesce(get(s, k - 1).x = get(s, k).x, false) or coalesce(get(s, k + 1).x = get(s, k).x, false)), k -> get(s, k).i)))[0]"
    )
    covered = f"transform(array({places}), p -> aggregate(sequence(1, size(p) - 1), {w}L, (n, k) -> n + least({w}, get(p, k) - get(p, k - 1))))[0]"
    repeats = f"case when size(_words) < {w + 1} then 0L else transform(array({hashes}), a -> case when size(array_distinct(a)) = size(a) then 0L else {covered} end)[0] end"
    a, b = unused(docs.columns, "_words", "_lines")
    out = docs.withColumns({a: F.expr(words), b: F.expr(lines)})
    repeats = repeats.replace("_words", f"`{a}`")
    return out.withColumns(
        {
            "n_words": F.expr(f"cast(size(`{a}`) as bigint)"),
            "word_chars": F.expr(f"cast(char_length(array_join(`{a}`, '')) as bigint)"),
            "n_symbols": F.expr(f"cast(char_length({t}) - char_length(translate({t}, '#*$%&|<>', '')) as bigint)"),
            "n_exclaims": F.expr(f"cast(char_length({t}) - char_length(replace({t}, '!', '')) as bigint)"),
            "n_uppers": F.expr(f"cast(char_length({t}) - char_length(regexp_replace({t}, '\\\\p{{Lu}}', '')) as bigint)"),
            "n_lines": F.expr(f"cast(size(`{b}`) as bigint)"),
            "n_dup_lines": F.expr(f"cast(size(`{b}`) - size(array_distinct(`{b}`)) as bigint)"),
            "n_repeat_words": F.expr(repeats),
        }
    ).drop(a, b).withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"))


def log_binomial_tail(k: str, n: str, p: str) -> str:
    """SQL: the logarithm of P(X <= k) for X binomial (n, p), summed exactly in logarithms."""
    step = f"s.term + ln(({n} - i + 1) / i) + ln({p} / (1 - {p}))"
    return (
        f"aggregate(sequence(1L, greatest({k}, 1L)), struct(cast({n} * ln(1 - {p}) as double) as term, cast({n} * ln(1 - {p}) as double) as total),"
        f" (s, i) -> case when i > {k} then s else transform(array({step}), x -> struct(x as term, greatest(s.total, x) + ln(1 + exp(-abs(s.total - x))) as total))[0] end).total"
    )


def calibrate(measures: DataFrame, labels: DataFrame, *, stratum: str = "lang", alpha: float = 0.02, delta: float = 0.05, price: float = 20.0) -> DataFrame:
    """A row per stratum: stratum and a cutoff per rule (null: off). labels: doc_id, quality (1: good)."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # Documents that fail the base rule are rejected whatever the cutoffs; the others are what cutoffs are answerable for.
    rows = measures.where("not base_failed").select("doc_id", F.col(f"`{stratum}`").alias("stratum"), *[F.expr(f"cast({e} as double)").alias(name) for name, (e, _) in RULES.items()]).join(known, "doc_id")
    sums, earlier = {"good": F.expr("count_if(quality = 1)")}, "false"
    for name, (_, cuts) in RULES.items():
        sums[f"{name}_first"] = F.expr(f"count_if(quality = 0 and {name} > {cuts[-1]}d and not ({earlier}))")
        earlier += f" or {name} > {cuts[-1]}d"
        for i, c in enumerate(cuts):
            sums[f"{name}_{i}_good"] = F.expr(f"count_if(quality = 1 and {name} > {c}d)")
            sums[f"{name}_{i}_bad"] = F.expr(f"count_if(quality = 0 and {name} > {c}d)")
    counts = rows.groupBy("stratum").agg(*[v.alias(k) for k, v in sums.items()])
    tests = ", ".join(f"struct('{name}' as rule, {c}d as cut, {name}_{i}_good as k, {name}_{i}_bad as bad, {name}_first / caught as part)" for name, (_, cuts) in RULES.items() for i, c in enumerate(cuts))
    caught = counts.withColumn("caught", F.expr(f"nullif({' + '.join(f'{name}_first' for name in RULES)}, 0)"))
    each = caught.select("stratum", "good", F.expr(f"inline(array({tests}))"))
    strata = counts.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("strata"))
    safe = each.join(F.broadcast(strata)).withColumn("share", F.expr(f"{alpha}d * part")).where("part > 0 and k < share * good").where(F.expr(f"{log_binomial_tail('k', 'good', 'share')} <= ln({delta}d * part / strata)")).where(f"bad > {price}d * k")
    best = safe.groupBy("stratum", "rule").agg(F.expr(f"max_by(cut, struct(bad - {price}d * k, cut))").alias("cut"))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == name, F.col("cut"))).alias(f"{name}_cut") for name in RULES])


def judged(measures: DataFrame, cutoffs: DataFrame, *, stratum: str = "lang") -> DataFrame:
    """The rows with `kept`. cutoffs: what calibrate gave, staged; its rows are counted before any broadcast."""
    names = dict(zip(["stratum", *[f"{r}_cut" for r in RULES]], unused(measures.columns, "stratum", *[f"{r}_cut" for r in RULES])))
    side = cutoffs.select(*[F.col(a).alias(b) for a, b in names.items()])
    side = F.broadcast(side) if cutoffs.count() <= BROADCAST_ROWS else side
    # greatest() skips nulls (rules that are off) and can't be split: an "or" would be pushed below the join in parts and the measures worked out twice.
    over = [f"cast({ratio} as double) > `{names[f'{r}_cut']}`" for r, (ratio, _) in RULES.items()]
    out = measures.join(side, F.col(f"`{stratum}`").eqNullSafe(F.col(f"`{names['stratum']}`")), "left")
    return out.withColumn("kept", F.expr(f"not greatest(base_failed, {', '.join(over)})")).drop(*names.values())
