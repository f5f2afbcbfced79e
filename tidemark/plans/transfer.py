"""Queries of records, sinks, validation, checkpoints, control tables, metrics and scans, with their SQL."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import control, incremental, mapping, merge, metrics, reconcile, records, routing
from tidemark.operators.mapping import Mapping, Rule
from tidemark.plans.registry import query
from tidemark.sources import sinks, store
from tidemark.sources.store import table
from tidemark.streaming import streams


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp()
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def values(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# Records

RAW = """case when c_custkey % 11 = 0 then '[1]' when c_custkey % 13 = 0 then '{"seg":1}' else concat('{ "name":"', c_name, '", "id": ', c_custkey, ', "seg":{"n":', c_nationkey, ',"m":"', c_mktsegment, '"}}') end"""
RECORD_SQL = """with a as (select c_custkey, c_nationkey n, c_custkey % 11 = 0 as arr, c_custkey % 11 <> 0 and c_custkey % 13 = 0 as nokey,
 '{"id":' || c_custkey || ',"name":"' || c_name || '","seg":{"m":"' || c_mktsegment || '","n":' || c_nationkey || '}}' j from customer),
r as (select *, case when arr then 'not a JSON object' when nokey then 'no key field id' end error from a) """


def _envelopes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", F.expr(RAW).alias("raw"))
    return records.canonical(rows, "raw", job="crm", api="document", namespace="crm|c", keys=["id"], watermark="seg.n").drop("raw")


@query(RECORD_SQL + """select c_custkey, 'crm' source_job, 'document' source_api, 'crm|c' source_namespace, case when error is null then c_custkey::varchar end source_key, case when error is null then 'crm|c|' || c_custkey end route_key,
case when error is null then j end payload, case when error is null then strlen(j)::bigint end payload_size_bytes, case when error is null then sha256(j) end checksum, case when error is null then n::varchar end event_ts, case when error is null then n::varchar end watermark, error from r""")
def canonical_record(spark, d):
    return _envelopes(spark, d)


@query("""with a as (select event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00"}' j, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' w from events)
select 'ev|' || event_id route_key, strlen(j)::bigint payload_size_bytes, sha256(j) checksum, w watermark from a""")
def canonical_rows(spark, d):
    rows = table(spark, d, "events").select("event_type", "event_id", "ts")
    return records.canonical_rows(rows, job="events", api="wide", namespace="ev", keys=["event_id"], watermark="ts").select("route_key", "payload_size_bytes", "checksum", "watermark")


@query("""select n_nationkey, '{"b":{"__base64__":"' || base64(n_name::blob) || '"},"d":"' || n_nationkey || '.50","day":"2026-01-02","l":["2026-01-02T03:04:05.000000+00:00"],"m":{"k":"1.25"},"none":null}' j from nation""")
def jsonable_nested(spark, d):
    rows = table(spark, d, "nation").selectExpr(
        "n_nationkey", "cast(n_name as binary) b", "cast(n_nationkey + 0.5 as decimal(10, 2)) d", "date '2026-01-02' day", "array(timestamp '2026-01-02 03:04:05') l", "map('k', cast(1.25 as decimal(4, 2))) m", "cast(null as string) none"
    )
    return rows.select("n_nationkey", records.row_payload(rows, ["b", "d", "day", "l", "m", "none"]).alias("j"))


@query("select '1|' || (c_nationkey % 2) || '|x' as key_text, sha256('1|' || (c_nationkey % 2) || '|x') as doc_id, count(*) n_rows from customer where c_custkey <= 50 group by 1")
def document_ids(spark, d):
    key = text.source_key(F.lit(1), F.expr("concat(c_nationkey % 2, '|x')"))
    return table(spark, d, "customer").where("c_custkey <= 50").groupBy(key.alias("key_text")).agg(text.document_id(F.first(key)).alias("doc_id"), F.count(F.lit(1)).alias("n_rows"))


@query("select 'p|' || (s_suppkey % 40) as route_key, count(distinct s_name) n_payloads from supplier group by 1 having count(distinct s_name) > 1")
def key_collisions(spark, d):
    rows = table(spark, d, "supplier").select(text.route_key(F.lit("p"), F.expr("cast(s_suppkey % 40 as string)")).alias("route_key"), text.checksum(F.col("s_name")).alias("checksum"))
    return records.ambiguous(rows)


# Sinks

SINK_SQL = RECORD_SQL + """, w as (select c_custkey k, case when c_custkey % 3 = 0 then 'relational' else 'document' end destination, case when c_custkey % 17 = 0 then j || ' ' else j end stored, j, c_custkey % 17 = 0 bad from r where error is null and c_custkey % 7 <> 0)
"""


@query(SINK_SQL + "select destination, count(*) n_rows, sum(strlen(j))::bigint n_bytes, count(*) filter (bad) n_stale, min('crm|c|' || k) first_key from w group by 1")
def sink_roundtrip(spark, d):
    """Envelopes written to both sinks in two runs, some deleted, some stored with a checksum that isn't theirs, and all read back."""
    rec = _envelopes(spark, d).where("error is null")
    path, found = scratch(spark), []
    for make, cond in ((sinks.document_sink, "c_custkey % 3 <> 0"), (sinks.relational_sink, "c_custkey % 3 = 0")):
        sink = make(spark, f"{path}/{make.__name__}", buckets=8)
        mine = rec.where(cond)
        sink.upsert(mine.withColumn("payload", F.lit("{}")))
        sink.upsert(mine.withColumn("checksum", F.expr("case when c_custkey % 17 = 0 then 'bad' else checksum end")))
        sink.delete(mine.where("c_custkey % 7 = 0"))
        found.append(sink)
    rows = sinks.all_records(*found)
    return rows.groupBy("destination").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("payload_size_bytes").alias("n_bytes"), F.count_if("stale").alias("n_stale"), F.min("route_key").alias("first_key"))


@query("select false written, count(*) n_rows from customer where c_custkey % 11 <> 0 and c_custkey % 13 <> 0")
def sink_dry_run(spark, d):
    sink = sinks.document_sink(spark, scratch(spark), dry=True)
    rec = _envelopes(spark, d).where("error is null")
    sink.upsert(rec)
    return sink.rows(rec).agg(F.lit(sink.read() is not None).alias("written"), F.count(F.lit(1)).alias("n_rows"))


# Validation

FOLD = "sha256(string_agg({0} || '|' || {1} || chr(10), '' order by {0}))"
RECON_SQL = RECORD_SQL + """, e as (select c_custkey k, 'crm|c|' || c_custkey rk, j, sha256(j) c, strlen(j)::bigint size, case when strlen(j) + 64 < 140 then 'document' when strlen(j) + 64 <= 144 then 'relational' else 'reject' end dest from r where error is null),
own as (select * from (values ('crm', 'job-crm'), ('crm|c', 'job-c'), ('none', 'job-none')) t(ns, job)),
x as (select rk, sha256('{"checksum":"' || c || '","destination":"' || dest || '","payload_size_bytes":' || size || '}') rd,
 sha256('{"checksum":"' || c || '","destination":"' || dest || '","payload_size_bytes":' || size || ',"source_api":"document","source_job":"crm","source_key":"' || k || '","source_namespace":"crm|c"}') wd from e where dest <> 'reject'),
g as (select case when k % 23 = 0 then 'x' || rk else rk end rk, sha256('{"checksum":"' || case when k % 29 = 0 then 'old' else c end || '","destination":"' || dest || '","payload_size_bytes":' || size || '}') gd, case when k % 31 = 0 then 'pending_cleanup' else 'complete' end st from e where dest <> 'reject' and k % 19 <> 0),
t as (select case when k % 37 = 0 then 'crm|' || k else rk end rk, sha256('{"checksum":"' || c || '","destination":"' || dest || '","payload_size_bytes":' || size || ',"source_api":"document","source_job":"' || case when k % 41 = 0 then 'other' else 'crm' end || '","source_key":"' || k || '","source_namespace":"crm|c"}') td, k % 43 = 0 stale from e where dest <> 'reject' and k % 17 <> 0),
ks as (select rk from e union select rk from g union select rk from t),
m as (select ks.rk, (select arg_max(job, length(ns)) from own where ks.rk = ns or starts_with(ks.rk, ns || '|')) job, rd, wd, gd, st, td, stale, e.dest = 'reject' rej from ks left join x on ks.rk = x.rk left join g on ks.rk = g.rk left join t on ks.rk = t.rk left join e on ks.rk = e.rk),
n as (select job, count(rd) source_count, count(gd) registry_count, count(td) target_count, count(*) filter (rej) source_rejected_rows, count(*) filter (rd is not null and gd is null) missing_registry_rows, count(*) filter (rd is null and gd is not null) extra_registry_rows, count(*) filter (rd <> gd) mismatched_registry_rows,
 count(*) filter (rd is not null and td is null) missing_target_rows, count(*) filter (rd is null and td is not null) extra_target_rows, count(*) filter (wd <> td) mismatched_target_rows, count(*) filter (st = 'pending_cleanup') pending_cleanup_rows, count(*) filter (stale) target_metadata_mismatches from m where job is not null group by 1),
l as (select job, rk, unnest(['a', 'b', 'c', 'd']) side, unnest([rd, gd, wd, td]) dg from m where job is not null),
b2 as (select job, side, substr(sha256(rk), 1, 2) b, """ + FOLD.format("rk", "dg") + """ dg from l where dg is not null group by 1, 2, 3),
b1 as (select job, side, substr(b, 1, 1) b, """ + FOLD.format("b", "dg") + """ dg from b2 group by 1, 2, 3),
b0 as (select job, side, """ + FOLD.format("b", "dg") + """ dg from b1 group by 1, 2)
select own.job, coalesce(source_count, 0) source_count, coalesce(registry_count, 0) registry_count, coalesce(target_count, 0) target_count, coalesce(source_rejected_rows, 0) source_rejected_rows, coalesce(missing_registry_rows, 0) missing_registry_rows, coalesce(extra_registry_rows, 0) extra_registry_rows,
 coalesce(mismatched_registry_rows, 0) mismatched_registry_rows, coalesce(missing_target_rows, 0) missing_target_rows, coalesce(extra_target_rows, 0) extra_target_rows, coalesce(mismatched_target_rows, 0) mismatched_target_rows, coalesce(pending_cleanup_rows, 0) pending_cleanup_rows, coalesce(target_metadata_mismatches, 0) target_metadata_mismatches,
 (select max(dg) from b0 where b0.job = own.job and side = 'a') source_route_checksum, (select max(dg) from b0 where b0.job = own.job and side = 'b') registry_checksum, (select max(dg) from b0 where b0.job = own.job and side = 'c') source_target_checksum, (select max(dg) from b0 where b0.job = own.job and side = 'd') target_checksum,
 coalesce(missing_registry_rows + extra_registry_rows + mismatched_registry_rows + missing_target_rows + extra_target_rows + mismatched_target_rows + pending_cleanup_rows + target_metadata_mismatches, 0) = 0 passed
from own left join n on own.job = n.job"""


@query(RECON_SQL)
def recon_v2(spark, d):
    e = _envelopes(spark, d).where("error is null").withColumn("destination", routing.destination(F.col("payload_size_bytes"), 140, 144, 64))
    live = e.where("destination <> 'reject'")
    reg = live.where("c_custkey % 19 <> 0").selectExpr("case when c_custkey % 23 = 0 then concat('x', route_key) else route_key end route_key", "destination", "case when c_custkey % 29 = 0 then 'old' else checksum end checksum", "payload_size_bytes size", "case when c_custkey % 31 = 0 then 'pending_cleanup' else 'complete' end sync_state")
    kept = live.where("c_custkey % 17 <> 0")
    names = sinks.RELATIONAL
    rows = kept.withColumns({"route_key": F.expr("case when c_custkey % 37 = 0 then concat('crm|', c_custkey) else route_key end"), "source_job": F.expr("case when c_custkey % 41 = 0 then 'other' else source_job end"), "checksum": F.expr("case when c_custkey % 43 = 0 then 'bad' else checksum end")})
    stored = [sinks.read_back(rows.where(F.col("destination") == dest).select(*[F.col(a).alias(b) for a, b in names.items()]), names, dest) for dest in ("document", "relational")]
    owned = values(spark, "namespace string, job string", [("crm", "job-crm"), ("crm|c", "job-c"), ("none", "job-none")])
    return reconcile.validate_routed(e, reg, stored[0].unionByName(stored[1]), owned, compare_event_ts=False)


@query("""with s as (select '[' || o_orderkey || ']' k, sha256(o_orderstatus || o_orderkey) d from orders), t as (select k, case when k like '%99]' then 'x' else d end d from s where k not like '%77]'),
f as (select s.k sk, t.k tk, s.d sd, t.d td from s full outer join t on s.k = t.k),
l as (select 's' side, k, d from s union all select 't', k, d from t), b1 as (select side, substr(sha256(k), 1, 1) b, """ + FOLD.format("k", "d") + """ d from l group by 1, 2), b0 as (select side, """ + FOLD.format("b", "d") + """ d from b1 group by 1)
select count(sk) source_rows, count(tk) target_rows, count(*) filter (tk is null) missing_rows, count(*) filter (sk is null) extra_rows, count(*) filter (sd <> td) mismatched_rows,
(select d from b0 where side = 's') source_checksum, (select d from b0 where side = 't') target_checksum, false passed from f""")
def recon_checks(spark, d):
    s = table(spark, d, "orders").select(text.key_text([("o_orderkey", "bigint")]).alias("key_text"), F.sha2(F.concat("o_orderstatus", "o_orderkey"), 256).alias("digest"))
    t = s.where("key_text not like '%77]'").withColumn("digest", F.expr("case when key_text like '%99]' then 'x' else digest end"))
    return reconcile.validate_plain(s, t, digits=1)


@query("select '[' || (o_custkey % 500) || ']' key_text, count(*) n_rows from orders group by 1 having count(*) > 1")
def recon_repeated_keys(spark, d):
    return reconcile.repeated_keys(table(spark, d, "orders").select(F.expr("concat('[', o_custkey % 500, ']')").alias("key_text"), F.lit("d").alias("digest")))


# Checkpoints

ADVANCE_SQL = """with st as (select * from (values (0, 300::bigint, ['e300', 'e299']), (1, 10::bigint, ['e9']), (2, 100000000::bigint, ['k'])) t(shard, w0, ks)),
a as (select cast(event_id % 5 as int) shard, event_id // 2 wm, 'e' || event_id k, md5(case when event_id % 5 < 2 then lpad(event_id::varchar, 12, '0') else event_id::varchar end) h, case when event_id % 5 < 2 then lpad(event_id::varchar, 12, '0') else md5(event_id::varchar) end arrival, event_id % 5 <> 1 or event_id % 1000 <> 6 ok from events),
b as (select a.*, w0, ks, coalesce(wm < w0 or (wm = w0 and list_contains(ks, k)), false) seen from a left join st on a.shard = st.shard),
c as (select *, greatest(w0, max(case when not seen then wm end) over (partition by shard order by arrival rows between unbounded preceding and 1 preceding)) top from b),
g as (select shard, max(w0) w0, count(*) filter (seen) n_skipped, count(*) filter (not seen and not ok) n_failed, count(*) filter (not seen and top is not null and wm < top) n_late, max(wm) filter (not seen and ok) nt from c group by 1),
h as (select g.*, n_failed > 0 or n_late > 0 blocked, (select list(k) from c where c.shard = g.shard and not seen and ok and wm = nt) nk, (select any_value(ks) from st where st.shard = g.shard) ks from g)
select shard, case when not blocked and nt is not null and (w0 is null or nt >= w0) then nt else w0 end watermark,
array_to_string(list_sort(case when not blocked and nt is not null and (w0 is null or nt >= w0) then case when nt = w0 then list_distinct(list_concat(ks, nk)) else nk end else ks end), ',') as keys, blocked, n_skipped, n_failed, n_late from h"""


@query(ADVANCE_SQL)
def inc_checkpoint_v2(spark, d):
    rows = table(spark, d, "events").selectExpr("cast(event_id % 5 as int) shard", "event_id div 2 wm", "concat('e', event_id) k", "case when event_id % 5 < 2 then lpad(cast(event_id as string), 12, '0') else md5(cast(cast(event_id as string) as binary)) end arrival", "event_id % 5 <> 1 or event_id % 1000 <> 6 ok")
    stored = values(spark, "shard int, watermark long, keys array<string>", [(0, 300, ["e300", "e299"]), (1, 10, ["e9"]), (2, 100000000, ["k"])])
    return incremental.advanced(rows, stored, ["shard"], "arrival", "wm", "k", F.col("ok")).withColumn("keys", F.array_join("keys", ","))


@query("select o_orderstatus, o_orderdate watermark, o_orderkey::varchar as key from orders o where o_orderdate = (select max(o_orderdate) from orders p where p.o_orderstatus = o.o_orderstatus)")
def inc_checkpoint_rows(spark, d):
    return incremental.checkpoint_rows(table(spark, d, "orders"), ["o_orderstatus"], "o_orderdate", "o_orderkey")


@query("""with a as (select s_suppkey, case when s_suppkey % 4 = 0 then null else s_suppkey % 5 end x, case when s_suppkey % 3 = 0 then null else s_suppkey % 4 end y from supplier)
select s_suppkey, cast(case when x is not distinct from y then 0 when x is null then -1 when y is null then 1 when x < y then -1 else 1 end as int) c, cast(case when coalesce(x, -1) = 1 then 0 when coalesce(x, -1) < 1 then -1 else 1 end as int) whole from a""")
def wm_compare(spark, d):
    rows = table(spark, d, "supplier").selectExpr("s_suppkey", "case when s_suppkey % 4 = 0 then null else s_suppkey % 5 end x", "case when s_suppkey % 3 = 0 then null else s_suppkey % 4 end y")
    return rows.select("s_suppkey", incremental.compare(F.col("x"), F.col("y")).alias("c"), incremental.compare_whole(F.coalesce(F.col("x").cast("string"), F.lit("none")), F.lit("1")).alias("whole"))


# Writes

BATCH = Mapping(rules=(Rule("k", "id", "int", required=True), Rule("kind", "type", "string"), Rule("n", "n", "int", default="7", has_default=True)), keys=("k",), delete_path="type", delete_value="error", watermark="at")
BATCH_SQL = """with a as (select event_id, event_id % 400 k, event_type, event_id % 6 = 0 bad, case when event_id % 4 = 0 then 7 else event_id end n, event_id // 10 ats from events),
l as (select * from (select *, '{"id":' || k || ',"type":"' || event_type || '"' || case when event_id % 4 = 0 then '' else ',"n":' || event_id end || ',"at":' || ats || '}' raw, row_number() over (partition by k order by ats desc, raw desc) rn from a where not bad) where rn = 1),
t as (select s_suppkey k, 'old' kind, cast(0 as bigint) n from supplier) """


def _batch(spark: SparkSession, d: str, mode: str) -> tuple[DataFrame, DataFrame]:
    raw = F.expr("""concat(case when event_id % 6 = 0 then '{"x":' else '{"id":' end, event_id % 400, ',"type":"', event_type, '"', case when event_id % 4 = 0 then '' else concat(',"n":', event_id) end, ',"at":', event_id div 10, '}')""")
    docs = table(spark, d, "events").withColumn("raw", raw).withColumn("doc", F.try_parse_json("raw"))
    target = table(spark, d, "supplier").selectExpr("cast(s_suppkey as bigint) k", "'old' kind", "cast(0 as bigint) n")
    return mapping.write_batch(target, mapping.project(docs, BATCH, keep=("raw",)), BATCH, "events", F.col("raw"), mode)


@query(BATCH_SQL + "select coalesce(t.k, l.k) k, case when l.k is null then t.kind else event_type end kind, case when l.k is null then t.n else l.n end n from t full outer join l on t.k = l.k where event_type is distinct from 'error'")
def write_upsert(spark, d):
    return _batch(spark, d, "upsert")[0]


@query(BATCH_SQL + "select 'k: missing id' reason, count(*) n_rows, max(ats) max_ts from a where bad union all select 'key exists', count(*), max(ats) from l where event_type <> 'error' and k in (select k from t)")
def write_insert_letters(spark, d):
    return _batch(spark, d, "insert")[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"), F.max("source_ts").alias("max_ts"))


@query("""with a as (select case when o_custkey % 10 = 0 then null else o_custkey end k, o_orderkey v from orders), c as (select k, count(*) n from a where k is not null group by 1)
select case when a.k is null then 'key is null' when n > 1 then 'key is repeated' else 'written' end outcome, count(*) n_rows from a left join c on a.k = c.k group by 1""")
def merge_guarded(spark, d):
    rows = table(spark, d, "orders").selectExpr("case when o_custkey % 10 = 0 then null else o_custkey end k", "o_orderkey v")
    good, bad = merge.checked(rows, ["k"])
    return good.select(F.lit("written").alias("outcome")).unionByName(bad.select(F.col("reason").alias("outcome"))).groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows"))


@query("select s_suppkey, cast(null as varchar) error, true as stamped, 3::bigint whole, s_suppkey % 2 = 0 as wrong from supplier")
def default_forms(spark, d):
    """Defaults in the type of their column: the marker is the time of the run, text that isn't a number is the row's error."""
    m = Mapping(rules=(Rule("id", "id", "int"), Rule("at", "at", "timestamp", default=mapping.NOW, has_default=True), Rule("whole", "w", "int", default="3", has_default=True)), keys=("id",))
    bad = Mapping(rules=(Rule("id", "id", "int"), Rule("w", "w", "int", default="soon", has_default=True)), keys=("id",))
    docs = table(spark, d, "supplier").select("s_suppkey", F.try_parse_json(F.expr("""concat('{"id":', s_suppkey, '}')""")).alias("doc"), F.try_parse_json(F.expr("""concat('{"id":', s_suppkey, case when s_suppkey % 2 = 0 then '}' else ',"w":4}' end)""")).alias("doc2"))
    a = mapping.project(docs, m, keep=("s_suppkey",)).select("s_suppkey", "error", F.col("at").isNotNull().alias("stamped"), "whole")
    b = mapping.project(docs, bad, doc="doc2", keep=("s_suppkey",)).select("s_suppkey", F.col("error").eqNullSafe(F.lit("w: default isn't int")).alias("wrong"))
    return a.join(b, "s_suppkey")


# Control tables

WORK_SQL = """with w as (select 'v2:j' || s_suppkey work_key, s_suppkey s from supplier), p as (select work_key, case s % 3 when 0 then 'running' when 1 then 'completed' else 'failed' end status, case when s % 2 = 0 then 'wa' else '' end owner_id, (s % 4)::bigint attempt_count, '' last_error, '2026-01-01' updated_at, s from w where s % 5 <> 0),
l as (select work_key, case s % 3 when 0 then 'wa' when 1 then 'wb' else 'wc' end owner_id, case s % 4 when 0 then '2026-01-01 00:00:00' when 1 then '2026-06-01 00:00:00' else 'soon' end expires_at, s from w where s % 7 <> 0) """


def _now() -> Column:
    return F.lit("2026-03-01 00:00:00").cast("timestamp")


def _control(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    w = table(spark, d, "supplier").select(control.work_key("v2", F.expr("concat('j', s_suppkey)")).alias("work_key"), F.col("s_suppkey").alias("s"))
    p = w.where("s % 5 <> 0").selectExpr("work_key", "case s % 3 when 0 then 'running' when 1 then 'completed' else 'failed' end status", "case when s % 2 = 0 then 'wa' else '' end owner_id", "cast(s % 4 as bigint) attempt_count", "'' last_error", "'2026-01-01' updated_at")
    held = w.where("s % 7 <> 0").selectExpr("work_key", "case s % 3 when 0 then 'wa' when 1 then 'wb' else 'wc' end owner_id", "case s % 4 when 0 then '2026-01-01 00:00:00' when 1 then '2026-06-01 00:00:00' else 'soon' end expires_at")
    return w.select("work_key"), p, held


@query(WORK_SQL + "select work_key, status, owner_id, attempt_count, last_error, updated_at from p union all select work_key, 'pending', '', 0, '', 'now' from w where s % 5 = 0")
def progress_seeded(spark, d):
    w, p, _ = _control(spark, d)
    return control.seeded(w, p, F.lit("now"))


@query(WORK_SQL + """, g as (select p.work_key from p left join l on p.work_key = l.work_key where status = 'running' and (expires_at is null or coalesce(try_cast(expires_at as timestamp) <= timestamp '2026-03-01', true)))
select p.work_key, case when g.work_key is null then status else 'failed' end status, owner_id, attempt_count, case when g.work_key is null then last_error else 'stale lease recovered previous_owner=' || coalesce(nullif(owner_id, ''), 'unknown') || ' updated_at=' || updated_at end last_error,
case when g.work_key is null then updated_at else '2026-03-01 00:00:00' end updated_at from p left join g on p.work_key = g.work_key""")
def progress_reclaimed(spark, d):
    _, p, held = _control(spark, d)
    return control.reclaimed(p, held, _now())


@query(WORK_SQL + """, f as (select coalesce(l.work_key, q.work_key) work_key, q.work_key is not null and (l.work_key is null or owner_id = 'wa' or coalesce(try_cast(expires_at as timestamp) <= timestamp '2026-03-01', true)) granted, owner_id, expires_at from l full outer join (select work_key from w where s % 2 = 0) q on l.work_key = q.work_key)
select work_key, case when granted then 'wa' else owner_id end owner_id, case when granted then '2026-03-01 00:02:00' else expires_at end expires_at, granted from f""")
def leases_asked(spark, d):
    w, _, held = _control(spark, d)
    even = w.where("cast(substring(work_key, 5) as int) % 2 = 0")
    return control.leased(held, even, "wa", _now(), 120)


@query(WORK_SQL + """, o as (select w.work_key, coalesce(status, 'pending') status, cast(list_sum(list_transform(string_split(':' || w.work_key, ''), lambda c: ascii(c))) % 1024 as bigint) rk from w left join p on w.work_key = p.work_key),
b as (select work_key from o where status = 'failed' order by rk, work_key limit 5)
select (select count(*) from o) n_items, (select count(*) from o where status = 'completed') n_completed, (select count(*) from o where status = 'failed') n_failed, (select count(*) from o where status = 'pending') n_pending, (select count(*) from o where status = 'running') n_running,
(select count(*) from p left join l on p.work_key = l.work_key where status = 'running' and (expires_at is null or coalesce(try_cast(expires_at as timestamp) <= timestamp '2026-03-01', true))) n_stale, (select string_agg(work_key, ',' order by work_key) from b) first_failed""")
def status_summary(spark, d):
    w, p, held = _control(spark, d)
    return control.status_summary(w, p.select("work_key", "status"), held.select("work_key", "expires_at"), _now())


@query("""select 'n' || (s_suppkey % 2) namespace, 'r' || s_suppkey record_key, case when s_suppkey % 3 = 0 then '{"v":2}' else '{"v":1}' end payload, case when s_suppkey % 3 = 0 then 'new' else 'old' end status, '' owner_id, cast(null as varchar) lease_expires_at,
case when s_suppkey % 3 = 0 then '2026-03-01 00:00:00' else '2026-01-01 00:00:00' end updated_at from supplier where s_suppkey % 5 <> 0""")
def state_put(spark, d):
    kinds = ["namespace", "record_key", "payload", "status", "owner_id", "lease_expires_at", "updated_at"]
    base = table(spark, d, "supplier").selectExpr("s_suppkey s", "concat('n', s_suppkey % 2) namespace", "concat('r', s_suppkey) record_key", """'{"v":1}' payload""", "'old' status", "'' owner_id", "cast(null as timestamp) lease_expires_at", "timestamp '2026-01-01' updated_at")
    new = base.where("s % 3 = 0").withColumns({"payload": F.lit('{"v":2}'), "status": F.lit("new")})
    out = control.drop_state(control.put_state(base.select(*kinds), new, _now()), base.where("s % 5 = 0"))
    return out.select(*kinds[:5], *[F.col(c).cast("string").alias(c) for c in kinds[5:]])


@query("select record_key, payload from (select 'v1:a' || s_suppkey record_key, s_name payload, s_suppkey % 2 n from supplier) where n = 1 and starts_with(record_key, 'v1:a1')")
def state_prefix(spark, d):
    rows = table(spark, d, "supplier").selectExpr("concat('n', s_suppkey % 2) namespace", "concat('v1:a', s_suppkey) record_key", "s_name payload")
    return store.state(rows, "n1", "v1:a1").select("record_key", "payload")


@query("select record_key, payload from (select 'r' || s_suppkey record_key, s_name payload, s_suppkey % 2 n from supplier) where n = 0 and record_key in ('r2', 'r3', 'r4')")
def state_get(spark, d):
    rows = table(spark, d, "supplier").selectExpr("concat('n', s_suppkey % 2) namespace", "concat('r', s_suppkey) record_key", "s_name payload")
    return store.state_of(rows, "n0", ["r2", "r3", "r4", "none"]).select("record_key", "payload")


@query("""select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' utc, '{"a":1,"b":' || event_id || '}' doc, event_type kind from events""")
def normalised_values(spark, d):
    rows = table(spark, d, "events").withColumn("doc", F.expr("""concat('{"b": ', event_id, ', "a":1 }')"""))
    return rows.select("event_id", text.normalised(F.col("ts"), "timestamp").alias("utc"), text.normalised(F.col("doc"), "json").alias("doc"), text.normalised(F.col("event_type"), "string").alias("kind"))


@query("select 'v1:' || r_name || '->T:shard=' || r_regionkey as work_key, 'run:v2:' || r_name as progress_key from region")
def work_keys(spark, d):
    return table(spark, d, "region").select(control.work_key("v1", F.col("r_name"), F.col("r_regionkey"), F.lit("T")).alias("work_key"), control.progress_key(F.lit("run"), control.work_key("v2", F.col("r_name"))).alias("progress_key"))


# Metrics

METRIC_SQL = """with s as (select event_type, user_id % 2 p, event_id, value from events),
m as (select 'metric_9rows_seen' as name, 'counter' as type, 'Rows seen' description, '{"label_1st":"a\\"b","type":"' || event_type || '"}' j, '{label_1st="a\\"b",type="' || event_type || '"}' r, count(*)::double v from s group by event_type
 union all select 'last_id', 'gauge', 'last_id', '{"p":"' || p || '"}', '{p="' || p || '"}', max(event_id)::double from s group by p
 union all select 'took_count', 'counter', 'Observation count for took.', '{}', '', count(*)::double from s union all select 'took_sum', 'counter', 'Observation sum for took.', '{}', '', sum(event_id % 10)::double from s
 union all select 'took_max', 'gauge', 'Maximum observed value for took.', '{}', '', max(event_id % 10)::double from s) """


def _samples(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    none = F.create_map().cast("map<string,string>")
    a = e.select(F.lit("9rows-seen").alias("name"), F.lit("counter").alias("kind"), F.create_map(F.lit("type"), F.col("event_type"), F.lit("1st"), F.lit('a"b'), F.lit("blank"), F.lit("")).alias("labels"), F.lit(1.0).alias("value"), F.col("event_id").alias("at"), F.lit("Rows seen").alias("description"))
    b = e.select(F.lit("last_id").alias("name"), F.lit("gauge").alias("kind"), F.create_map(F.lit("p"), F.expr("cast(user_id % 2 as string)")).alias("labels"), F.col("event_id").cast("double").alias("value"), F.col("event_id").alias("at"), F.lit("").alias("description"))
    c = e.select(F.lit("took").alias("name"), F.lit("observe").alias("kind"), none.alias("labels"), F.expr("cast(event_id % 10 as double)").alias("value"), F.col("event_id").alias("at"), F.lit(None).cast("string").alias("description"))
    return a.unionByName(b).unionByName(c)


@query(METRIC_SQL + "select name, type, description, r labels, cast(v as bigint) as whole from m")
def metrics_series(spark, d):
    return metrics.collected(_samples(spark, d)).select("name", "type", "description", metrics.rendered(F.col("labels")).alias("labels"), F.col("value").cast("long").alias("whole"))


@query(METRIC_SQL + """select name, j labels, type from m""")
def metrics_json(spark, d):
    rows = metrics.json_lines(metrics.collected(_samples(spark, d)))
    return rows.select("name", F.get_json_object("line", "$.labels").alias("labels"), F.get_json_object("line", "$.type").alias("type"))


@query(METRIC_SQL + "select distinct name, 0 part, '# HELP ' || name || ' ' || description line from m union all select distinct name, 1, '# TYPE ' || name || ' ' || type from m")
def prom_heads(spark, d):
    return metrics.text_lines(metrics.collected(_samples(spark, d))).where("part < 2")


@query("select * from (values ('took', 'counter,gauge', 2::bigint)) t(name, kinds, n)")
def metrics_clashes(spark, d):
    rows = [("took", "counter", 1.0), ("took", "gauge", 2.0), ("x", "gauge", 1.0)]
    return metrics.clashing(values(spark, "name string, kind string, value double", rows))


@query("""with a as (select doc_id, strlen(coalesce(text, '')) + 64 s, doc_id % 6 = 5 new, doc_id % 4 = 1 bad, doc_id % 9 = 2 late, doc_id % 10 = 3 seen from documents),
b as (select *, case when s < 2000 then 'document' when s <= 8000 then 'relational' else 'reject' end destination, case when s > 8000 then 'reject' when new then 'insert' else 'update' end as action from a)
select destination, count(*) records, count(*) filter (not seen and action = 'reject') n_reject, 0::bigint n_finalize, 0::bigint n_skip, count(*) filter (not seen and action = 'insert') n_insert, count(*) filter (not seen and action = 'update') n_update, 0::bigint n_move,
count(*) filter (not seen and not bad and destination = 'document') document_writes, count(*) filter (not seen and not bad and destination = 'relational') relational_writes, count(*) filter (seen) checkpoint_skipped, count(*) filter (not seen and late) out_of_order, count(*) filter (not seen and bad and action <> 'reject') failed, 0::bigint cleanup_failed from b group by 1""")
def route_counters(spark, d):
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    rec = table(spark, d, "documents").select("doc_id", F.concat(F.lit("d|"), "doc_id").alias("route_key"), size.alias("size"), F.lit("c").alias("checksum"), routing.destination(size, 2000, 8000, 64).alias("destination"))
    reg = rec.where("doc_id % 6 <> 5").selectExpr("route_key", "destination", "'old' checksum", "size", "'t' updated_at", "'complete' sync_state", "cast(null as string) cleanup_from")
    return routing.statistics(routing.actions(rec, reg), ["destination"], ok=F.expr("doc_id % 4 <> 1"), late=F.expr("doc_id % 9 = 2"), seen=F.expr("doc_id % 10 = 3"))


# Scans

@query("select o_orderkey, o_orderdate from orders where o_orderstatus = 'O' and o_orderkey >= 500")
def bounded_scan(spark, d):
    return store.bounded(table(spark, d, "orders"), {"o_orderstatus": "O", "o_orderkey": 3}, "o_orderkey", 500).select("o_orderkey", "o_orderdate")


@query("select event_id from events where event_id % 4 = 3 and event_id >= 100")
def template_shard(spark, d):
    table(spark, d, "events").createOrReplaceTempView("events_scan")
    sql = store.templated("select event_id from events_scan where event_id % {{SHARD_COUNT}} = {{SHARD_INDEX}} and event_id >= :watermark", 3, 4)
    return store.incremental_query(spark, "events_scan", "event_id", 100, sql)


@query("select p_partkey, p_size from part")
def ordered_scan(spark, d):
    return store.ordered_rows(table(spark, d, "part"), ["p_partkey"], store.read_columns(["p_partkey"], ["p_size", "p_partkey"]))


@query("with a as (select o_orderkey, row_number() over (order by o_orderkey) - 1 n from orders) select o_orderkey, n // 200 batch from a")
def write_batches(spark, d):
    return store.numbered_batches(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 200)


@query("select ['lost'] as missing, true as readable, false as empty_readable")
def preflight(spark, d):
    rows = table(spark, d, "nation")
    rows.createOrReplaceTempView("nation_scan")
    missing = store.missing_columns(spark, "nation_scan", ["n_name", "lost", "n_name"])
    return values(spark, "missing array<string>, readable boolean, empty_readable boolean", [(missing, store.probe(rows), store.probe(rows.where("n_nationkey < 0")))])


@query("select n_nationkey, n_name a, case n_nationkey when 0 then null else n_name end b from nation")
def document_scan(spark, d):
    """Documents written as JSON lines and scanned again; what isn't JSON has no document."""
    path = scratch(spark)
    table(spark, d, "nation").select(F.expr("""case when n_nationkey = 0 then 'broken' else to_json(struct(n_nationkey, n_name)) end""").alias("value"), "n_nationkey", "n_name").write.partitionBy("n_nationkey", "n_name").text(path)
    raw = store.documents(spark, f"{path}/*/*").select(F.try_variant_get("doc", "$.n_nationkey", "int").alias("k"), F.try_variant_get("doc", "$.n_name", "string").alias("b"))
    return table(spark, d, "nation").join(raw, F.col("n_nationkey") == F.col("k"), "left").select("n_nationkey", F.col("n_name").alias("a"), "b")


# Streaming

@query("""with l as (select * from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn from events) where rn = 1), r as (select 'ev|' || user_id route_key, event_id size, event_type checksum, case when event_id + 8 < 40000 then 'document' when event_id + 8 <= 80000 then 'relational' else 'reject' end destination from l)
select route_key, destination, checksum, size::bigint size, 't' updated_at, 'complete' sync_state, cast(null as varchar) cleanup_from from r where destination <> 'reject'""")
def stream_route(spark, d):
    """The routing state machine over a stream; the registry it leaves."""
    run = scratch(spark)
    source = streams.file_changes(spark, d, table(spark, d, "events").schema, "events.parquet")
    rec = source.select("ts", "event_id", F.concat(F.lit("ev|"), "user_id").alias("route_key"), F.col("event_id").cast("long").alias("size"), F.col("event_type").alias("checksum"), routing.destination(F.col("event_id"), 40000, 80000, 8).alias("destination"))
    return streams.run_routing(rec, f"{run}/table", f"{run}/checkpoint", ["ts", "event_id"], F.lit("t"), buckets=8)
