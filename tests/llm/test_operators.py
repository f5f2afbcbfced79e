"""Operators over small tables with nulls, empty and long texts, repeated rows, clashing columns and no rows."""

import collections
import json
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe_codec, html_text, impact_search, jaccard_join, language, licenses, line_dedup, packing, quality, queries, records
from tidemark.llm.common import gathered, scratch, tokenizer_file, tracked
from tidemark.llm.common import table as table_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start long, h1 string, root string, pos int"


def texts(n=60, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["an", "er", "th", "on", "re", "st"]) for _ in range(rng.randrange(1, 4)))
    base = [" ".join(word() for _ in range(40)) for _ in range(n // 4)]
    out = []
    for i in range(n):
        w = rng.choice(base).split()
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = word()
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(100, None), (101, ""), (102, " \n"), (103, "a"), (None, "lone null id here now yes"), (104, "Word, " * 9000), (104, "Word, " * 9000), (105, "A"), (7, "another text of id seven, quite other words")]
    return spark.createDataFrame([(i, t, "en" if (i or 0) % 2 else None, "s", 0, 1, "x", "y", 2) for i, t in rows], SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def ids(t, end):
    return [*Tokenizer.from_file(tokenizer_file()).encode(t or "", add_special_tokens=False).ids, end]


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


def test_records_round_trip(spark, table, empty):
    want, at = [], 0
    tie = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + 2**63) % 2**64 if t is not None else 2**63 + 42
    for d, t in sorted(pairs(table), key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1]))):
        x = ids(t, 2)
        want.append((d, at, len(x), crc(x)))
        at += len(x)
    assert sorted(map(tuple, records.records(table).select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1]) == want
    path = scratch(spark, "t")
    records.write_records(table, path)
    index = records.write_index(spark, path, path + "-i")
    got = records.read_at(index.where("doc_id % 9 = 0"), path).collect()
    by = {d: t for d, t in pairs(table) if d is not None and d % 9 == 0}
    assert {r.doc_id: r.ids for r in got} == {d: ids(t, 2) for d, t in by.items()}
    assert records.records(empty).count() == 0


def test_packing(table, empty):
    rows = packing.packed(table, capacity=64).collect()
    seqs = collections.defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 64
    want = []
    for d, t in pairs(table):
        x = ids(t, 0)
        cuts = [0, *range(len(x) % 64 or 64, len(x) + 1, 64)]
        want += [(d, n, a, b - a, crc(x[a:b])) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    assert packing.packed(empty).count() == 0
    whole = {(r.doc_id, r.start, r.length, r.ids_crc32) for r in rows}
    data = packing.sequences(table, capacity=64).collect()
    assert sum(r.n_tokens for r in data) == sum(r.length for r in rows) and all(len(r.ids) == 4 * r.n_tokens <= 256 for r in data)
    pieces = collections.Counter(zlib.crc32(r.ids[4 * a : 4 * b]) for r in data for a, b in zip(r.starts, [*r.starts[1:], r.n_tokens]))
    assert pieces == collections.Counter(r.ids_crc32 for r in rows) and len(whole) <= len(rows)


def test_codec(table, empty):
    tk = Tokenizer.from_file(tokenizer_file())
    for r in bpe_codec.encode_decode(table).collect():
        assert tk.decode(r.ids, skip_special_tokens=False) == r.decoded
    assert bpe_codec.digests(table).count() == table.count() and bpe_codec.digests(empty).count() == 0


def brute_components(rows):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    sets = []
    for _, t in rows:
        w = word.findall((t or "").lower())
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set()))
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b) and comp[i] != comp[j]:
                comp = [comp[j] if c == comp[i] else c for c in comp]
    least = {}
    for c, (d, _) in zip(comp, rows):
        if d is not None:
            least[c] = min(least.get(c, d), d)
    return [(d, len(s), least.get(c)) for (d, _), s, c in zip(rows, sets, comp)]


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join(spark, table, empty, seed):
    df = table if seed == 1 else spark.createDataFrame(list(enumerate(texts(150, seed))), "doc_id long, text string")
    key = lambda r: tuple(map(str, r))
    got = [tuple(r) for r in jaccard_join.join(df).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=key) == sorted(brute_components(pairs(df)), key=key)
    if seed == 1:
        assert jaccard_join.join(empty).count() == 0


def test_language(table, empty):
    rows = {(r.doc_id, r.lang_pred, r.score) for r in language.identify(table).collect()}
    assert {(100, "und", 0.0), (101, "und", 0.0)} <= rows and all(0 <= s <= 1 for _, _, s in rows)
    assert language.identify(empty).count() == 0
    assert {r.lang_pred for r in language.identify(table.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_with_clashing_columns(table):
    df = table.withColumns({n: F.concat(F.lit(n), F.coalesce("doc_id", F.lit(0))) for n in ("score", "held_out", "lang_pred", "_text", "languages")})
    out = language.identify(df, keep=["score", "lang", "_text", "text", "held_out"])
    assert out.columns == ["doc_id", "held_out", "score_", "lang", "_text_", "text", "held_out_", "lang_pred", "score", "languages"]
    assert out.where("score_ <> concat('score', coalesce(doc_id, 0)) or held_out_ not like 'held_out%'").count() == 0 and out.count() == df.count()
    same = [(r.text, r.lang_pred, r.score) for r in out.where("doc_id = 104").collect()]
    assert len(same) == 2 and same[0] == same[1]


def test_too_many_languages(spark):
    df = spark.range(2 * language.MOST).selectExpr("id doc_id", "'some text' text", "concat('l', id) lang")
    with pytest.raises(ValueError):
        language.identify(df)


def test_mixtures_are_those_of_a_plain_version(spark, table):
    """EM on the same likelihoods, written out plainly."""
    import math

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    m = language.learn(docs)
    for text in [r.text for r in docs.limit(20).collect() if r.text]:
        at, n = language.trigrams(text)
        like = m.likelihood[:, at].T
        share = [1 / len(m.langs)] * len(m.langs)
        for _ in range(20):
            new = [0.0] * len(share)
            for row, c in zip(like.tolist(), n.tolist()):
                mixed = [x * s for x, s in zip(row, share)]
                for i, x in enumerate(mixed):
                    new[i] += c * x / sum(mixed)
            share = [x / n.sum() for x in new]
        value = sum(c * math.log(sum(x * s for x, s in zip(row, share))) for row, c in zip(like.tolist(), n.tolist()))
        got, found = m.mixture(like, n, 20)
        assert np.allclose(got, share, atol=1e-9) and abs(found - value) < 1e-6 * abs(value)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    got = language.identify(docs, keep=["lang"]).where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)


def test_repeated_passages(spark, empty):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    fresh = lambda n: " ".join(word() + ("," if i % 7 == 6 else "") for i in range(n))
    passage = ". ".join(fresh(9) for _ in range(7)) + "."
    rows = [(1, f"{fresh(30)} {passage} {fresh(30)}"), (2, f"{fresh(20)} {passage} {fresh(25)}"), (3, fresh(80)), (4, None), (5, ""), (6, "Short line.\nShort line.")]
    got = {r.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and got[3].clean_text == rows[2][1] and got[4].clean_text is None and got[6].n_removed == 0
    r = got[2]
    assert r.n_removed == 1 and passage not in r.clean_text
    a, b = r.removed_spans[0]
    assert r.text[:a] + r.text[b:] == r.clean_text and r.text[a:b] in rows[0][1] and len(r.text[a:b].split()) > 45
    assert line_dedup.dedup(empty).count() == 0


def test_passages_cut_inside_clauses(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    fresh = lambda n, k: " ".join(word() + ("," if k and i % k == k - 1 else "") for i in range(n))
    passages = [fresh(52, k) for k in (0, 0, 45, 26, 9)]
    rows = [(i, f"{fresh(30, 11)} {passages[i % 5]} {fresh(30, 11)}") for i in range(15)]
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    seen = set()
    for r in got:
        at, w = [m.span() for m in re.finditer(r"\S+", r.text)], r.text.split()
        again = {j for i in range(len(w) - 49) if tuple(w[i : i + 50]) in seen for j in range(i, i + 50)}
        seen |= {tuple(w[i : i + 50]) for i in range(len(w) - 49)}
        assert [j for j, (s, e) in enumerate(at) if any(a <= s and e <= b for a, b in r.removed_spans)] == sorted(again)


def test_passages_with_clashing_columns(spark):
    rows = [(i, f"own{i} words{i}\nThis line is everywhere.", "mine", i, "k", None) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, clean_text string, k_id long, box string, n_units long")
    out = line_dedup.dedup(df)
    assert out.columns == ["doc_id", "text", "k_id", "box", "clean_text", "n_units", "n_removed", "removed_spans"]
    assert sorted((r.doc_id, r.k_id, r.box, r.n_removed) for r in out.collect()) == [(i, i, "k", int(i > 0)) for i in range(4)]


def test_short_lines_of_many_documents(spark):
    rows = [(i, f"own{i} words{i} here{i}\nThis line is everywhere.\n\nmore{i} of{i} these{i}\nTwo words.") for i in range(20)]
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.clean_text == (r.text.replace("This line is everywhere.\n", "") if r.doc_id else r.text) for r in got)


def test_passages_of_rows_that_share_an_id(spark):
    passage = " ".join(f"word{i}" for i in range(40))
    rows = [(d, f"a{n} {passage} b{n}") for n, d in enumerate([None, None, None])] + [(7, f"c{n} {passage[::-1]} d{n}") for n in range(3)]
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (0, 1), (0, 1), (7, 0), (7, 1), (7, 1)]


def test_search(spark):
    rng = random.Random(2)
    some = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(300)]
    rows = [(i, v, 0) for i, v in enumerate(some)] + [(400, None, 0), (450, [1.0, None], 0), (500, [float("nan")] * 4, 0), (None, [1.0] * 4, 0), (550, [1.0, 0.5], 0), (601, [float("inf")] * 4, 0)]
    rows += [(650, some[0], 0), (650, some[0], 0), (651, some[7], 0), (652, some[7], 0), (652, some[7], 0), (700, [], 0), (750, [0.5, 0.25, 1.0, -1.0, 0.125, 0.5], 0)]  # repeats, ties, none and more components
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").withColumns({"part": F.lit("x"), "q": F.lit(1), "block": F.lit(2)})
    v = [(i, np.floor(256 * np.array([*np.float32(e), *[0] * 6][:6], float)).astype(int)) for i, e, _ in rows if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    want = []
    for i, q in v:
        if i % 50 == 0:
            best = sorted((-int(q @ x), j) for j, x in v if j != i)[:5]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    for block in (64, 1024):
        got = sorted(map(tuple, impact_search.search(df, block=block, group=4).collect()))
        assert got == sorted(want)
    assert impact_search.search(df.limit(0)).count() == 0


def plain_scan(t):
    words = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall((t or "").encode().lower())
    hits = [(i, k) for p, k in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.encode().split()]
    at = [i for i, _ in hits]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({k for _, k in hits}))


def test_licenses(spark, table, empty):
    """The base columns against a plain scan, over the documents and the odd table; the method's labels are added to the base ones."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(table.select("doc_id", "text"))
    mit = licenses.library()["mit"].replace("<<beginOptional>>", "").replace("<<endOptional>>", "").replace("<<var;name=holder;match=.{1,200}>>", "the authors")
    more = spark.createDataFrame([(900, mit), (901, mit.replace("merge,", "")), (902, ("x " * 50000) + mit), (900, mit)], "doc_id long, text string")
    both = docs.unionByName(more).withColumns({"labels": F.lit("clash"), "n_words": F.lit("clash"), "score": F.lit(3)})
    want = sorted((d, *plain_scan(t)) for d, t in pairs(both) if d is not None)
    got = licenses.scan(both).collect()
    assert sorted((tuple(r)[:6] for r in got if r.doc_id is not None), key=lambda r: tuple(map(str, r))) == sorted(want, key=lambda r: tuple(map(str, r)))
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) and (r.score == 1.0) == (r.labels != r.base_labels) for r in got if r.base_labels)
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r.labels)
    assert by[900] == ["mit", "mit"] and by[901] == [""] and by[902] == ["mit"]
    assert licenses.scan(empty).count() == 0
    assert [tuple(r)[1:8] for r in licenses.scan(table.where("doc_id in (100, 101)")).collect()] == [(0, 0, None, None, "", "", 0.0)] * 2


def plain_measures(t):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    w = word.findall(t or "")
    seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (t or "").split("\n") if word.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(spark, table):
    rng = random.Random(4)
    odd = [(i, "".join(rng.choice(["a", "b", " ", " ", "\n", "#", "é", "\x0b", "\x1c"]) for _ in range(rng.randrange(120)))) for i in range(80)]
    df = spark.createDataFrame(pairs(table) + odd, "doc_id long, text string").withColumns({n: F.lit(f"{n} clash") for n in ("n_lines", "_words", "_lines", "symbol_ratio", "stratum", "symbol_ratio_cut")}).withColumn("lang", F.lit("en"))
    m = quality.measured(df)
    got = [(r.text, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in m.collect()]
    assert all(m == plain_measures(t) for t, m in got)
    cuts = quality.calibrate(m, spark.createDataFrame([], "doc_id long, quality int")).cache()
    out = quality.judged(m, cuts)
    assert {*df.columns} <= {*out.columns} and out.where("_words <> '_words clash' or symbol_ratio <> 'symbol_ratio clash' or stratum <> 'stratum clash' or symbol_ratio_cut <> 'symbol_ratio_cut clash'").count() == 0
    assert {(r.text, r.kept) for r in out.collect()} == {(r.text, not r.base_failed) for r in out.collect()}


def test_quality_cutoffs(spark):
    good = [(i, "word other thing " * 2 + " ".join(f"w{i}x{j}" for j in range(30)), "en") for i in range(3000)]
    bad = [(10000 + i, " ".join(f"w{i}x{j}###" for j in range(30)), "en") for i in range(200)]
    few = [(20000 + i, " ".join(f"w{i}y{j}###" for j in range(30)), None) for i in range(10)]
    docs = spark.createDataFrame(good + bad + few, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(d, int(d < 10000)) for d, _, _ in good + bad + few] + [(None, 1), (5, 1)], "doc_id long, quality int")
    m = quality.measured(docs)
    cuts = quality.calibrate(m, labels).cache()
    kept = {r.doc_id: r.kept for r in quality.judged(m, cuts).collect()}
    assert all(kept[d] for d, _, _ in good + few) and not any(kept[d] for d, _, _ in bad)
    none = quality.calibrate(m.limit(0), labels.limit(0)).cache()
    assert quality.judged(m.limit(0), none).count() == 0 and all(r.kept for r in quality.judged(m, none).collect())


def test_quality_cutoffs_of_small_strata(spark):
    rows = [(1000 * n + i, " ".join(f"w{i}x{j}" + ("###" if i >= 311 else "") for j in range(30)), lang) for n, lang in enumerate(["de", "en", "es", "fr"]) for i in range(340)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(d, int(d % 1000 < 311)) for d, _, _ in rows], "doc_id long, quality int")
    m = quality.measured(docs)
    kept = {r.doc_id: r.kept for r in quality.judged(m, quality.calibrate(m, labels).cache()).collect()}
    assert all(k == (d % 1000 < 311) for d, k in kept.items())


def test_quality_stages_few_files(spark, tmp_path):
    """A file per 64 MB of documents, not one per task that reads them; no row is lost on the way."""
    d, rows = str(tmp_path), [(i, t, "en" if i % 3 else None) for i, t in enumerate([*texts(), None, "", "a b " * 50])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(0, 1), (None, 0)], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    conf, key = spark.conf, "spark.sql.files.maxPartitionBytes"
    before = conf.get(key)
    conf.set(key, "2k")
    try:
        docs = table_of(spark, d, "documents")
        assert docs.rdd.getNumPartitions() >= 6
        with tracked(spark) as paths:
            got = queries.op10_quality(spark, d).collect()
        assert [len(spark.read.parquet(p).inputFiles()) for p in paths] == [1, 1]
        assert gathered(docs, docs, each=1).rdd.getNumPartitions() == 4 and gathered(docs, docs, each=1).count() == len(rows)
    finally:
        conf.set(key, before)
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == [(i, *plain_measures(t)) for i, t, _ in rows]


def test_binomial_tail(spark):
    from math import comb, log

    for k, n, p in [(0, 10, 0.1), (3, 200, 0.02), (7, 50, 0.3)]:
        want = log(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))
        got = spark.sql(f"select {quality.log_binomial_tail(f'{k}L', f'{n}L', f'{p}d')} x").first().x
        assert abs(got - want) < 1e-9


def test_pages(spark):
    page = lambda body: f"<html><body><div class=side><p>{'menu ' * 40}</p></div><div class=c12><p>{body}</p></div></body></html>"
    rows = [(i, f"http://a.b/{i}", page("long text " * 30)) for i in range(5)] + [(9, "http://a.b/9", page("tiny")), (10, None, None), (11, "x", ""), (12, "http://long/", page("word " * 200_000)), (9, "http://a.b/9", page("tiny"))]
    rows += [(20 + i, f"http://tie/{i}", f"<body><div class={c}><p>{'same words ' * 9}</p></div></body>") for i, c in enumerate("ab")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("clash"), "paths": F.lit(1), "text": F.lit("clash")})
    for size in (1 << 20, 0):  # winning paths broadcast, or joined by shuffle
        out = html_text.extract(df, broadcast_bytes=size).collect()
        got = {r.page_id: r.text for r in out}
        assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
        assert got[9] == "tiny" and got[10] == "" and got[11] == "" and got[0].startswith("long text") and len(got[12]) == 999_999
        assert got[20] == got[21] == ("same words " * 9).strip()
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_near_copies_without_ids(spark):
    import corpus_pipeline

    copies = [" ".join(f"w{j}" for j in range(60)) + f" end{i}" for i in range(4)]
    other = [" ".join(f"v{j}" for j in range(60)) + f" end{i}" for i in range(3)]
    rows = [(None, t) for t in copies] + [(5, t) for t in other] + [(None, other[0] + " more"), (9, "alone")]
    got = pairs(corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), ""))
    assert sorted((str(d), t[:2]) for d, t in got) == [("5", "v0"), ("9", "al"), ("None", "w0")]


CLASH = ["k_id", "k_text", "held_out", "score", "n_lines", "_stratum", "clean_text", "box", "root", "kept", "lang_pred"]


def test_stages_on_odd_tables(spark, tmp_path):
    """Nulls, empty and repeated rows, long texts, columns of the operators' names, and no rows."""
    import corpus_pipeline

    d = str(tmp_path)
    prose = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars > 300 and lang = 'en'").limit(12).collect()]
    rows = [(i, t, "en") for i, t in enumerate(prose)] + [(0, prose[0], "en"), (None, prose[1], None), (None, prose[1] + " more", "en"), (50, None, "en"), (51, "", None), (52, "\n", "en"), (53, " ".join(prose * 40), "en"), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    for c in CLASH:
        df = df.withColumn(c, F.concat(F.lit(c), F.coalesce("doc_id", F.lit(-1))))
    spark.createDataFrame([(0, 1), (None, 0), (0, 0)], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    for docs in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:4]:
            before = docs.dtypes
            docs = corpus_pipeline.staged(stage(spark, docs, d), name)
            assert docs.dtypes == before, name
            assert docs.where(" or ".join(f"`{c}` <> concat('{c}', coalesce(doc_id, -1))" for c in CLASH)).count() == 0, name
        out = corpus_pipeline.best_fit_packing(spark, docs, d)
        assert (out.count() > 0) == (docs.count() > 0)


def test_pipeline_equals_a_plain_version(spark):
    """run() against its stages written out plainly: the language model's verdicts are taken, the rest is worked out anew."""
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    told = {r.doc_id for r in language.identify(docs).collect() if r.lang_pred != "und" and r.score >= 0.34}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in told]
    # Quality: this table's labels prove no cutoff, so the base rule decides.
    sound = quality.calibrate(quality.measured(docs.where(F.col("doc_id").isin(*told))), spark.read.parquet(f"{d}/labels.parquet"))
    assert sound.where(" or ".join(f"{r}_cut is not null" for r in quality.RULES)).count() == 0
    rows = [(i, t) for i, t in rows for m in [plain_measures(t)] if m[0] >= 20 and 100 * m[4] <= 30 * m[0]]
    rows = [(i, t) for (i, t), (_, _, c) in zip(rows, brute_components(rows)) if c == i]
    # Repeated passages: runs of ten-word windows, clauses and whole lines that an earlier document has too.
    seen, cut = set(), []
    for i, t in sorted(rows):
        x = line_dedup.entries(t, 4)
        again = np.array([h in seen or h in x[:n].tolist() for n, h in enumerate(x.tolist())], bool)
        seen |= set(x.tolist())
        at, parts = 0, []
        for a, b in line_dedup.cut(t, again, 20, 12, 4) if again.any() else []:
            parts.append(t[at:a])
            at = b
        if re.search(r"\S", t := "".join([*parts, t[at:]])):
            cut.append((i, t))
    want = []
    for i, t in cut:
        x = ids(t, 0)
        cuts = [0, *range(len(x) % 2048 or 2048, len(x) + 1, 2048)]
        want += [(i, n, a, b - a, crc(x[a:b])) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    out = corpus_pipeline.run(spark, d).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    ends = collections.defaultdict(list)
    for r in out:
        ends[r.sequence_id].append((r.offset, r.length))
    assert all(o == sum(n for _, n in s[:j]) for s in map(sorted, ends.values()) for j, (o, _) in enumerate(s)) and all(sum(n for _, n in s) <= 2048 for s in ends.values())
