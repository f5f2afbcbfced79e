import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import logs
from tidemark.functions import convert, text
from tidemark.operators import control, incremental, mapping, merge, metrics, reconcile, routing
from tidemark.operators.mapping import Mapping, Rule
from tidemark.sources import sinks, store
from tidemark.streaming import streams

PARCELS = Mapping(
    rules=(
        Rule("parcel", "no", "string", required=True),
        Rule("grams", "load.mass.g", "int"),
        Rule("fragile", "load.fragile", "bool"),
        Rule("second_stop", "stops.1.harbour", "string"),
        Rule("load_json", "load", "json_string"),
    ),
    keys=("parcel",),
    statics={"copied_at": mapping.NOW},
    delete_path="void",
    delete_value=True,
)


def docs(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "raw string").withColumn("doc", F.try_parse_json("raw"))


def test_nested_projection(spark):
    raw = '{"no":"P-7","_ts":42,"load":{"mass":{"g":"1250"},"fragile":"y"},"stops":[{"harbour":"Bergen"},{"harbour":"Riga"}],"void":0}'
    r = mapping.project(docs(spark, raw), PARCELS).first()
    assert (r.parcel, r.grams, r.fragile, r.second_stop, r.source_ts, r.is_delete, r.error) == ("P-7", 1250, True, "Riga", 42, False, None)
    assert r.load_json == '{"fragile":"y","mass":{"g":"1250"}}' and r.copied_at is not None
    assert PARCELS.volatile() == {"copied_at"} and PARCELS.compared() == ["parcel", "grams", "fragile", "second_stop", "load_json"]
    assert PARCELS.compared(("grams",)) == ["parcel", "grams"]


def test_deletes_and_errors(spark):
    df = docs(spark, '{"no":"P-8","void":true}', '{"load":{}}', "no document", '{"no":"P-9","void":1}', '{"no":"P-1","_ts":"soon"}', '{"no":"P-2","_ts":null}', '{"no":"P-3","_ts":""}')
    got = [(r.disposition, r.error) for r in mapping.disposed(mapping.project(df, PARCELS)).collect()]
    assert got == [("delete", None), ("failed", "parcel: missing no"), ("failed", "not a JSON document"), ("delete", None), ("failed", "_ts: not int"), ("upsert", None), ("upsert", None)]
    letters = mapping.dead_letters(mapping.project(df, PARCELS, keep=("raw",)), "parcels", F.col("raw")).collect()
    assert [x.payload for x in letters] == ['{"load":{}}', "no document", '{"no":"P-1","_ts":"soon"}']


def test_missing_is_not_null(spark):
    m = Mapping(rules=(Rule("id", "id", "int"), Rule("a", "a", "string", default="d", has_default=True)), keys=("id",))
    got = [r.a for r in mapping.project(docs(spark, '{"id":1}', '{"id":2,"a":null}', '{"id":3,"a":"x"}'), m).collect()]
    assert got == ["d", None, "x"]


@pytest.mark.parametrize("bad", [dict(keys=("x",)), dict(keys=("a b",)), dict(keys=())])
def test_mapping_is_checked(bad):
    with pytest.raises(ValueError):
        Mapping(rules=(Rule("id", "id"),), **bad)


def test_converters(spark):
    def one(kind, json):
        return docs(spark, json).select(convert.CONVERTERS[kind](F.col("doc")).alias("x")).first().x

    assert [one("int", x) for x in ("3.9", '"12.5"', '" 7 "', "true")] == [3, None, 7, 1]
    assert [one("bool", x) for x in ('"Y"', '"t"', "0", "2", "true", '"no"')] == [True, None, False, True, True, False]
    assert one("string", "true") == "True" and one("float", '" 1.5 "') == 1.5
    assert one("timestamp", '"2026-03-12T12:00:00Z"') == datetime(2026, 3, 12, 12) == one("timestamp", "1773316800")
    assert one("timestamp", '"12:30"') is None


def test_golden_digests(spark):
    df = spark.sql("select 'u1' user_id, timestamp '2026-03-12 12:00:00' created_at")
    assert df.select(text.key_text([("user_id", "string")])).first()[0] == '["u1"]'
    rows = spark.createDataFrame([('["u1"]', "a" * 64), ('["u2"]', "b" * 64)], "k string, d string")
    assert rows.agg(reconcile.fold(F.col("k"), F.col("d"))).first()[0] == "fdf03da201188898c367d35941c6217873a9a31ad15b0e0e94a824747d55c12b"
    c = spark.sql("""select '{"v":"xxxxxxxxxx", "id":"1"}' j""").select(text.checksum(text.canonical_json(F.col("j")))).first()[0]
    assert c == "59e8f5d95dba33c9c9c012d40b3e522020deec55c4f5dfa7d5d911b4a0de4433"


@pytest.mark.parametrize("n", [2, 7, 16])
def test_shards(spark, n):
    names = ["u1", "u2", "u3", "tenant-42", ""]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in names], "t string").select(text.stable_shard(F.col("t"), n)).collect()]
    assert got == [int(hashlib.sha256(x.encode()).hexdigest(), 16) % n for x in names]


def test_classes_swap_with_sides(spark):
    s = spark.createDataFrame([("u1", "a"), ("u2", "b")], "key_text string, digest string")
    t = spark.createDataFrame([("u2", "c"), ("u3", "d")], "key_text string, digest string")
    assert tuple(reconcile.summary(reconcile.classified(s, t)).first()) == (2, 2, 1, 1, 1)
    assert tuple(reconcile.summary(reconcile.classified(t, s)).first()) == (2, 2, 1, 1, 1)


def test_three_way(spark):
    e = spark.createDataFrame([("1", "a", "b"), ("2", "c", "d")], "key string, route_digest string, row_digest string")
    g = spark.createDataFrame([("1", "a", "complete"), ("2", "e", "pending_cleanup"), ("3", "f", "complete")], "key string, digest string, sync_state string")
    t = spark.createDataFrame([("1", "b", False), ("2", "f", False), ("4", "0", False)], "key string, digest string, stale boolean")
    r = reconcile.three_way_summary(reconcile.three_way(e, g, t)).first()
    assert (r.source_rows, r.registry_rows, r.target_rows) == (2, 3, 3)
    assert (r.missing_registry, r.extra_registry, r.mismatched_registry, r.missing_target, r.extra_target, r.mismatched_target, r.pending_cleanup) == (0, 1, 1, 0, 1, 1, 1)


def test_route_thresholds(spark):
    def to(n, lo, hi):
        return spark.range(1).select(routing.destination(F.lit(n), lo, hi)).first()[0]

    assert [to(1000, 1048576, 10000000), to(1048576, 1048576, 10000000), to(2000001, 1048576, 2000000)] == ["document", "relational", "reject"]


def test_move_then_finalize(spark):
    rec = lambda n, c: spark.createDataFrame([("k", "document" if n < 1000 else "relational", c, n)], "route_key string, destination string, checksum string, size long")
    reg = spark.createDataFrame([], "route_key string, destination string, checksum string, size long, updated_at string, sync_state string, cleanup_from string")
    for n, c, failed, action, state, origin in [(500, "a", False, "insert", "complete", None), (2000, "b", True, "move", "pending_cleanup", "document"), (2000, "b", False, "finalize", "complete", None), (2000, "b", False, "skip", "complete", None)]:
        acted = routing.actions(rec(n, c), reg)
        assert acted.first().action == action
        reg = spark.createDataFrame(routing.next_registry(acted, reg, F.lit(failed), F.lit("t")).collect(), reg.schema)
        assert (reg.first().sync_state, reg.first().cleanup_from) == (state, origin)


def test_merge_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    rows = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    once = merge.upsert(t, rows, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", "x"), (2, None, "y"), (3, "c", None)]
    assert sorted(map(tuple, merge.upsert(once, rows, ["k"]).collect())) == sorted(map(tuple, once.collect()))


def test_unsorted_arrivals_are_kept(spark):
    df = spark.createDataFrame([("9", 10), ("10", 5), ("11", 12)], "key string, wm long")
    assert incremental.after(df, "wm", 7, 5).count() == 3
    assert incremental.checkpoint(df, "wm", "key").first()["keys"] == "11"


def test_hold_on_failure(spark):
    df = spark.createDataFrame([("j", 10), ("j", 12)], "job string, ts long")
    assert incremental.held(df, ["job"], "ts", F.col("ts") == 12, F.lit(5).cast("long")).first().watermark == 5
    assert incremental.held(df, ["job"], "ts", F.lit(False), F.lit(5).cast("long")).first().watermark == 12


def test_fingerprint_is_stable():
    assert control.fingerprint({"a": 1, "b": [2]}) == control.fingerprint({"b": [2], "a": 1}) != control.fingerprint({"a": 2, "b": [2]})


def test_versions_and_letters(spark, tmp_path):
    v = store.Versions(spark, f"file://{tmp_path}/t")
    assert v.read() is None
    for n in range(3, 9):
        v.publish(spark.range(n))
    assert v.read().count() == 8
    assert len(list((tmp_path / "t").glob("v-*"))) == 3  # older ones have gone
    top = max((tmp_path / "t" / "_pointers").glob("0*"))
    (top.parent / f".{top.name}.crc").unlink(missing_ok=True)
    top.write_text("{")
    with pytest.raises(ValueError):
        v.current()
    store.append_dead_letters(spark.range(2).withColumn("t", F.current_timestamp()), str(tmp_path / "dlq"))
    store.append_dead_letters(spark.range(2).withColumn("t", F.current_timestamp()), str(tmp_path / "dlq"))
    assert spark.read.json(str(tmp_path / "dlq")).count() == 4


def test_bounds_replace_a_condition_on_their_field(spark):
    df = spark.range(10)
    assert store.bounded(df, {"id": 3}, "id", 7).count() == 3
    assert store.bounded(df, {"id": 3}).count() == 1


def test_a_crash_between_steps_keeps_the_table(spark, tmp_path, monkeypatch):
    v = store.Versions(spark, f"file://{tmp_path}/t")
    v.publish(spark.range(3))

    class Broken:
        """A file system that fails at the n-th call that changes something."""

        def __init__(self, fs, n):
            self.fs, self.n = fs, n

        def __getattr__(self, name):
            if name in ("create", "delete", "rename"):
                self.n -= 1
                if self.n < 0:
                    raise OSError("crash")
            return getattr(self.fs, name)

    whole = v.fs
    for n in range(3):
        v.fs = Broken(whole, n)
        try:
            v.publish(spark.range(10 + n))
        except OSError:
            pass
        v.fs = whole
        assert v.read().count() in (3, *range(10, 11 + n))
    empty = whole.create(v._p(f"_pointers/{v._pointers()[0] + 1:012d}"), False)  # a pointer whose text never came
    empty.close()
    before = v.read().count()
    v.publish(spark.range(99))
    assert before < 99 and v.read().count() == 99


def test_a_merge_rewrites_the_buckets_it_touches(spark, tmp_path):
    v = store.Versions(spark, f"file://{tmp_path}/t")
    keep = lambda old, new: new if old is None else merge.upsert(old, new, ["k"])
    row = lambda *rows: spark.createDataFrame(rows, "k long, v string")
    v.merge(row(*[(i, "a") for i in range(100)]), ["k"], keep, buckets=8)
    first = v.current()["parts"]
    v.merge(row((5, "b"), (500, "c")), ["k"], keep)
    changed = {b for b, x in v.current()["parts"].items() if first.get(b) != x}
    assert 1 <= len(changed) <= 2 and v.merge(row().limit(0), ["k"], keep) is None
    got = {r.k: r.v for r in v.read().collect()}
    assert len(got) == 101 and got[5] == "b" and got[500] == "c" and got[6] == "a"


def test_streams_of_folders_and_of_nothing(spark, tmp_path):
    schema = "k long, at long, gone boolean"
    spark.createDataFrame([(i % 7, i, i == 13) for i in range(20)], schema).repartition(3).write.parquet(str(tmp_path / "in" / "changes.parquet"))
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "in" / "none.parquet"))
    for name, want in (("changes.parquet", [(0, 14), (1, 15), (2, 16), (3, 17), (4, 18), (5, 19)]), ("none.parquet", [])):
        source = streams.file_changes(spark, f"file://{tmp_path}/in", schema, name)
        live = streams.run_changes(source, f"file://{tmp_path}/{name}-t", f"file://{tmp_path}/{name}-c", ["k"], ["at"], "gone")
        assert sorted((r.k, r.at) for r in live.collect()) == want


def test_merges_refuse_what_would_be_lost(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    for f in (merge.insert, merge.update, merge.upsert, merge.replace):
        with pytest.raises(ValueError):
            f(t, spark.createDataFrame([(1, "a")], "k int, w string"), ["k"])
    good, bad = merge.checked(spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, v string"), ["k"])
    assert [r.k for r in good.collect()] == [1] and sorted(r.reason for r in bad.collect()) == ["key is null", "key is repeated", "key is repeated"]


def test_running_maxima_in_two_passes(spark):
    import random

    rng = random.Random(3)
    rows = [(g, i, rng.randrange(200), f"k{rng.randrange(9)}") for g in "ab" for i in range(300)]
    df = spark.createDataFrame(rows, "g string, at long, wm long, k string").repartition(5)
    late, kept = set(), set()
    for g in "ab":
        top, best = 50, None
        for _, i, w, k in [r for r in rows if r[0] == g]:
            if w < top:
                late.add((g, i))
            top = max(top, w)
            if best is None or (w, k) > best:
                best = (w, k)
                kept.add((g, i))
    assert {(r.g, r.at) for r in incremental.disorder(df, ["g"], "at", "wm", 50, ranges=7).where("late").collect()} == late
    assert {(r.g, r.at) for r in incremental.rising(df, ["g"], "at", "wm", "k", ranges=7).collect()} == kept


@pytest.mark.parametrize("policy", ["max", "ties", "last"])
def test_merge_policies(spark, policy):
    old = spark.createDataFrame([("a", 1, ["x"], "p", 5)], "key string, watermark long, keys array<string>, value string, at long")
    new = spark.createDataFrame([("a", 1, ["y"], "q", 5)], old.schema)
    cols = {"max": ["key", "watermark"], "ties": ["key", "watermark", "keys"], "last": ["key", "value", "at"]}[policy]
    got = incremental.merge_state(old.select(cols), new.select(cols), policy, value="value", at="at").first()
    assert tuple(got) == {"max": ("a", 1), "ties": ("a", 1, ["x", "y"]), "last": ("a", "q", 5)}[policy]
    with pytest.raises(ValueError):
        incremental.merge_state(old, new, "first")


def test_gate_is_enforced(spark):
    rec = control.gate_record("v2", "stage", "s", "passed", "f", ["b", "a", "a"], "2026-02-28 00:00:00")
    rows = spark.createDataFrame([rec | {"details": None}], "pipeline string, environment string, scope string, status string, fingerprint string, checks array<string>, attested_at string, details string")
    now = F.lit("2026-03-01 00:00:00").cast("timestamp")
    ask = lambda **more: control.enforce(rows, **({"environment": "prod", "required": True, "pipeline": "v2", "scope": "s", "workload": "f", "checks": ["a", "b"], "now": now, "max_age_hours": 48} | more))
    ask()
    ask(environment="stage", scope="none")
    ask(required=False, workload="g")
    for more in ({"workload": "g"}, {"scope": "other"}, {"checks": ["c"]}, {"max_age_hours": 1}):
        with pytest.raises(PermissionError):
            ask(**more)


def test_fingerprints():
    a = control.workload_fingerprint("v1", [{"name": "x", "key": "secret"}], {"batch_size": 5, "log": "a"})
    assert a == control.workload_fingerprint("v1", [{"name": "x", "key": "other"}], {"batch_size": 5}) != control.workload_fingerprint("v2", [{"name": "x"}], {"batch_size": 5})
    assert control.scope_fingerprint(job="a", shard=None) == control.scope_fingerprint(job="a") != control.scope_fingerprint(job="a", shard=0)


def test_registered_converters(spark):
    convert.register("doubled", lambda v: F.try_variant_get(v, "$", "bigint") * 2)
    try:
        m = Mapping(rules=(Rule("k", "k", "doubled"), Rule("raw", "k")), keys=("k",))
        r = mapping.project(docs(spark, '{"k":4}'), m).select("k", F.to_json("raw").alias("raw")).first()
        assert (r.k, r.raw) == (8, "4")
        with pytest.raises(ValueError):
            convert.register("int", lambda v: v)
    finally:
        del convert.CONVERTERS["doubled"]


def test_scans(spark):
    assert store.sort_spec(["b", "a"], "t", "_id") == ["t", "b", "a", "_id"] and store.sort_spec(["t"], "t") == ["t"]
    spark.range(10).createOrReplaceTempView("ten")
    assert store.incremental_query(spark, "ten").count() == 10 and store.incremental_query(spark, "ten", "id", 7).count() == 3
    assert store.incremental_query(spark, "ten", None, None, "select * from ten where :watermark is null or id >= :watermark").count() == 10
    with pytest.raises(ValueError):
        store.incremental_query(spark, "ten", "id", 7, "select * from ten")
    assert store.missing_columns(spark, "no_such", ["a", "a"]) == ["a"]


def test_metrics_snapshots(spark, tmp_path):
    import json

    rows = [("n", "counter", {"b": "x\ny", "a": "1"}, 2.0, 1, "all"), ("n", "counter", {"a": "1", "b": "x\ny"}, 3.0, 2, ""), ("g", "gauge", None, 1.0, 1, None), ("g", "gauge", None, 0.5, 2, None)]
    series = metrics.collected(spark.createDataFrame(rows, metrics.SAMPLES), {"b": "static", "c": "d"}).cache()
    metrics.write_snapshot(series, str(tmp_path / "t"))
    lines = [x for f in (tmp_path / "t").glob("part*") for x in f.read_text().split("\n") if x]
    assert lines == ["# HELP g g", "# TYPE g gauge", 'g{b="static",c="d"} 0.5', "# HELP n all", "# TYPE n counter", 'n{a="1",b="x\\ny",c="d"} 5.0']
    metrics.write_snapshot(series, str(tmp_path / "j"), "json")
    got = [json.loads(x) for f in (tmp_path / "j").glob("part*") for x in f.read_text().split("\n") if x]
    assert got[1] == {"description": "all", "labels": {"a": "1", "b": "x\ny", "c": "d"}, "name": "n", "type": "counter", "value": 5.0}


def test_log_lines():
    import json
    import logging

    record = logging.LogRecord("tidemark.x", logging.INFO, "f", 1, "%s rows", (3,), None)
    line = json.loads(logs.Lines("json", run="r1", worker="").format(record))
    assert (line["message"], line["run"], line["level"]) == ("3 rows", "r1", "INFO") and "worker" not in line
    assert logs.Lines("text", run="r1").format(record).endswith("INFO tidemark.x 3 rows run=r1")
    assert len(logs.configure().handlers) == len(logs.configure(form="json").handlers) == 1


def test_source_adapters(spark, tmp_path):
    spark.createDataFrame([(1, None, "x"), (2, "b", "y")], "k long, part string, v string").write.parquet(str(tmp_path / "t"))
    rows = {r.source_key: r for r in sinks.TableSource(str(tmp_path / "t"), job="j", api="wide", namespace="n", keys=["k", "part"]).records(spark).collect()}
    assert set(rows) == {"1|None", "2|b"} and rows["2|b"].payload == '{"k":2,"part":"b","v":"y"}' and rows["2|b"].route_key == "n|2|b"


def test_fold_digits():
    assert [reconcile.fold_digits(n) for n in (0, 10**5, 10**7, 10**12)] == [1, 1, 2, 7]


def test_json_states(spark, tmp_path):
    assert store.json_state(spark, f"file://{tmp_path}/none.json") == {}
    for text, want in (('{"a":\n{"b": 1}}', {"a": {"b": 1}}), ("{", None), ("[1]", None), ("", None)):
        path = tmp_path / f"s{abs(hash(text))}.json"
        path.write_text(text)
        if want is None:
            with pytest.raises(ValueError):
                store.json_state(spark, f"file://{path}")
        else:
            assert store.json_state(spark, f"file://{path}") == want


def test_sessions():
    from tidemark.session import SETTINGS, session

    assert session("tests").conf.get("spark.sql.session.timeZone") == SETTINGS["spark.sql.session.timeZone"]
