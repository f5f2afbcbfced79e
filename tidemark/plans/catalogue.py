"""Queries over the test tables, one or more for each operator, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import convert, text
from tidemark.operators import control, incremental, mapping, merge, metrics, reconcile, routing
from tidemark.operators.mapping import Mapping, Rule
from tidemark.plans.registry import query
from tidemark.sources.store import by_keys, table
from tidemark.streaming import streams

def values(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def cents(name: str) -> Column:
    return F.round(F.col(name) * 100).cast("long")


# Reconciliation

ORDERS_SQL = """
with src as (select o_orderkey k, cast(round(o_totalprice * 100) as bigint) p, o_orderstatus s, o_orderpriority pr from orders),
tgt as (select k, case when k % 89 = 0 then p + 100 else p end p, s, pr from src where k % 97 <> 0
  union all select -k - 1, p, s, pr from src where k % 101 = 0),
a as (select '[' || k || ']' key_text, sha256('{"k":' || k || ',"p":' || p || ',"s":"' || s || '"}') d from src),
b as (select '[' || k || ']' key_text, sha256('{"k":' || k || ',"p":' || p || ',"s":"' || s || '"}') d from tgt),
m as (select coalesce(a.key_text, b.key_text) key_text, a.d s, b.d t from a full outer join b on a.key_text = b.key_text)
"""


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), cents("o_totalprice").alias("p"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("pr"))


def _perturbed(src: DataFrame) -> DataFrame:
    kept = src.where("k % 97 <> 0").withColumn("p", F.expr("case when k % 89 = 0 then p + 100 else p end"))
    return kept.unionByName(src.where("k % 101 = 0").withColumn("k", F.expr("-k - 1")))


def _digested(df: DataFrame) -> DataFrame:
    kinds = [("k", "bigint"), ("p", "bigint"), ("s", "string")]
    return df.select(text.key_text(kinds[:1]).alias("key_text"), text.row_digest(kinds).alias("digest"))


def _classified(spark: SparkSession, d: str) -> DataFrame:
    src = _orders(spark, d)
    return reconcile.classified(_digested(src), _digested(_perturbed(src)))


@query(ORDERS_SQL + """select count(s) source_rows, count(t) target_rows, count(*) filter (t is null) missing_rows, count(*) filter (s is null) extra_rows,
 count(*) filter (s <> t) mismatched_rows from m""")
def recon_summary(spark, d):
    return reconcile.summary(_classified(spark, d))


@query(ORDERS_SQL + "select key_text, case when t is null then 'missing' when s is null then 'extra' else 'mismatched' end status from m where s is distinct from t")
def recon_rows(spark, d):
    return _classified(spark, d).where("status <> 'equal'").select("key_text", "status")


@query("""with a as (select o_orderpriority pr, '[' || o_orderkey || ']' k, sha256('{"k":' || o_orderkey || ',"p":' || cast(round(o_totalprice * 100) as bigint) || ',"s":"' || o_orderstatus || '"}') d from orders)
select pr, count(*) n_rows, sha256(string_agg(k || '|' || d || chr(10), '' order by k)) checksum from a group by pr""")
def recon_checksum(spark, d):
    rows = _orders(spark, d).select("pr", text.key_text([("k", "bigint")]).alias("k"), text.row_digest([("k", "bigint"), ("p", "bigint"), ("s", "string")]).alias("dg"))
    return rows.groupBy("pr").agg(F.count(F.lit(1)).alias("n_rows"), reconcile.fold(F.col("k"), F.col("dg")).alias("checksum"))


@query("""with a as (select '[' || o_orderkey || ']' k, sha256('{"k":' || o_orderkey || ',"p":' || cast(round(o_totalprice * 100) as bigint) || ',"s":"' || o_orderstatus || '"}') d from orders),
b2 as (select substr(sha256(k), 1, 2) b, count(*) n, sha256(string_agg(k || '|' || d || chr(10), '' order by k)) d from a group by 1),
b as (select substr(b, 1, 1) b, sum(n) n, sha256(string_agg(b || '|' || d || chr(10), '' order by b)) d from b2 group by 1)
select cast(sum(n) as bigint) n_rows, sha256(string_agg(b || '|' || d || chr(10), '' order by b)) checksum from b""")
def recon_checksum_buckets(spark, d):
    return reconcile.bucket_folds(_digested(_orders(spark, d)), [])


@query("""select c_custkey, '[' || c_custkey || ',"' || c_mktsegment || '"]' key_text, sha256('{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}') digest from customer""")
def row_digest(spark, d):
    kinds = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_mktsegment", "string")]
    return table(spark, d, "customer").select("c_custkey", text.key_text([kinds[0], kinds[3]]).alias("key_text"), text.row_digest(kinds).alias("digest"))


@query(ORDERS_SQL + """, s0 as (select * from (select * from src order by k limit 500) where k % 10 <> 3 order by k limit 100), j as (select s0.*, tgt.k tk, tgt.p tp, tgt.s ts from s0 left join tgt on s0.k = tgt.k)
select count(*) sampled, count(*) filter (tk is null) missing_keys, cast(coalesce(sum(case when tk is not null then cast(p is distinct from tp as int) + cast(s is distinct from ts as int) end), 0) as bigint) field_mismatches,
count(*) filter (tk is not null and (p is distinct from tp or s is distinct from ts)) row_mismatches from j""")
def sample_validate(spark, d):
    src = _orders(spark, d).withColumns({"is_delete": F.expr("k % 10 = 3"), "error": F.lit(None).cast("string")})
    return reconcile.sample_compare(src, _perturbed(_orders(spark, d)), "k", ["p", "s"], 100)


@query(ORDERS_SQL + """select (select count(*) from src) source_rows, (select count(*) from src where k % 10 <> 3) expected_rows, (select count(*) from tgt) target_rows,
(select count(*) from tgt) - (select count(*) from src where k % 10 <> 3) delta""")
def count_delta(spark, d):
    src = _orders(spark, d)
    return reconcile.count_check(src, _perturbed(src), F.expr("k % 10 = 3"), F.lit(False))


@query("""select ns job, count(*) n_rows, bool_or(bad) failed from (select o_orderstatus ns, o_orderkey % 97 = 0 and o_orderstatus <> 'P' bad from orders) group by ns""")
def validation_rollup(spark, d):
    return table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("job")).agg(F.count(F.lit(1)).alias("n_rows"), F.bool_or(F.expr("o_orderkey % 97 = 0 and o_orderstatus <> 'P'")).alias("failed"))


# Mapping and conversion

EVENT_DOC = """concat('{"id":', event_id, ',"user":', user_id, ',"type":"', event_type, '","flag":"', case when event_id % 2 = 0 then 'yes' else 'N' end, '","tags":["t', event_id % 5, '","x"],"props":', props,
 case when event_id % 7 = 0 then ',"note":null' when event_id % 7 = 1 then ',"note":"n1"' else '' end, ',"_ts":', unix_seconds(cast(ts as timestamp)), '}')"""


def _event_docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("raw", F.expr(EVENT_DOC)).withColumn("doc", F.try_parse_json("raw"))


EVENTS = Mapping(
    rules=(
        Rule("event_id", "id", "int", required=True),
        Rule("user_name", "user", "string"),
        Rule("kind", "type", "string"),
        Rule("k", "props.k", "int"),
        Rule("k_float", "props.k", "float"),
        Rule("flag", "flag", "bool"),
        Rule("first_tag", "tags.0", "string"),
        Rule("props_json", "props", "json_string"),
        Rule("unset", None),
    ),
    keys=("event_id",),
    statics={"tenant": "acme"},
    delete_path="type",
    delete_value="error",
)


@query("""select event_id, cast(user_id as varchar) user_name, event_type kind, cast(json_extract_string(props, '$.k') as bigint) k, cast(json_extract_string(props, '$.k') as double) k_float, event_id % 2 = 0 flag,
't' || (event_id % 5) first_tag, '{"k":' || json_extract_string(props, '$.k') || '}' props_json, cast(null as varchar) unset, 'acme' tenant, event_type = 'error' is_delete, cast(floor(epoch(ts)) as bigint) source_ts, cast(null as varchar) error from events""")
def map_project(spark, d):
    return mapping.project(_event_docs(spark, d), EVENTS)


@query("""select event_id, case when event_id % 7 = 0 then null when event_id % 7 = 1 then 'n1' else 'none' end note, 'gone' missing_default, cast(json_extract_string(props, '$.k') as bigint) k,
case when event_id % 7 > 1 then 'strict: missing note' end error from events""")
def path_missing_default(spark, d):
    m = Mapping(
        rules=(
            Rule("event_id", "id", "int"),
            Rule("note", "note", "string", default="none", has_default=True),
            Rule("missing_default", "props.missing", "string", default="gone", has_default=True),
            Rule("k", "props.k", "int"),
            Rule("strict", "note", "string", required=True),
        ),
        keys=("event_id",),
    )
    return mapping.project(_event_docs(spark, d), m).select("event_id", "note", "missing_default", "k", "error")


WORDS_SQL = "case o_orderkey % 8 when 0 then ' Yes ' when 1 then 'N' when 2 then 'TRUE' when 3 then '0' when 4 then 't' when 5 then 'f' when 6 then '1' else '' end"


@query(f"with a as (select o_orderkey, {WORDS_SQL} word from orders) select o_orderkey, word, case when lower(trim(word)) in ('true', '1', 'yes', 'y') then true when lower(trim(word)) in ('false', '0', 'no', 'n') then false end flag from a")
def convert_bool(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.expr(WORDS_SQL).alias("word")).withColumn("flag", convert.bool_of_text(F.col("word")))


INT_SQL = "case p_partkey % 5 when 0 then '\"' || p_size || '\"' when 1 then '\" ' || p_size || ' \"' when 2 then '\"' || p_size || '.5\"' when 3 then p_size || '.9' else 'true' end"


@query("""with a as (select p_partkey, p_size, p_partkey % 5 c from part) select p_partkey, cast(case c when 2 then null when 4 then 1 else p_size end as bigint) n,
case c when 2 then p_size + 0.5 when 3 then p_size + 0.9 when 4 then 1.0 else p_size end::double x, c = 2 failed from a""")
def convert_int_strict(spark, d):
    v = F.try_parse_json(F.expr(INT_SQL))
    n = convert.CONVERTERS["int"](v)
    return table(spark, d, "part").select("p_partkey", n.alias("n"), convert.CONVERTERS["float"](v).alias("x"), n.isNull().alias("failed"))


@query("""select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' iso, cast(epoch_us(date_trunc('second', ts)) as bigint) micros, cast(null as bigint) bad from events""")
def convert_ts(spark, d):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(spark, d, "events").select("event_id", text.iso_utc(F.col("ts")).alias("iso"), F.unix_micros(convert.timestamp_of_text(iso)).alias("micros"), F.unix_micros(convert.timestamp_of_text(F.lit("12:30"))).alias("bad"))


NATION_JSON = """'{"key":' || n_nationkey || ',"name":"' || n_name || '","region":{"id":' || n_regionkey || '}}'"""


@query(f"select n_nationkey, {NATION_JSON} canonical, cast(strlen({NATION_JSON}) as bigint) n_bytes, sha256({NATION_JSON}) checksum, '[1|x]|' || n_nationkey || '|None' route_key from nation")
def json_canonical(spark, d):
    raw = F.expr("""concat('{ "region" : {"id":', n_regionkey, '}, "name": "', n_name, '" , "key":', n_nationkey, ' }')""")
    c = text.canonical_json(raw)
    key = text.source_key(F.col("n_nationkey"), F.lit(None))
    return table(spark, d, "nation").select("n_nationkey", c.alias("canonical"), text.json_bytes(c).alias("n_bytes"), text.checksum(c).alias("checksum"), text.route_key(F.lit("[1|x]"), key).alias("route_key"))


# Change data

STRICT = Mapping(rules=(Rule("event_id", "id", "int", required=True), Rule("note", "note", "string"), Rule("user_id", "user", "int")), keys=("event_id", "note"), delete_path="type", delete_value="error")
DISPOSED_SQL = """with a as (select *, case when event_id % 7 <> 1 then 'failed' when event_type = 'error' then 'delete' else 'upsert' end disposition from events) """


@query(DISPOSED_SQL + "select event_type, disposition, count(*) n_rows, max(cast(floor(epoch(ts)) as bigint)) max_ts from a group by all")
def cdc_split(spark, d):
    rows = mapping.disposed(mapping.project(_event_docs(spark, d), STRICT, keep=("event_type",)))
    return rows.groupBy("event_type", "disposition").agg(F.count(F.lit(1)).alias("n_rows"), F.max("source_ts").alias("max_ts"))


@query("""select 'events' job, cast(event_id as bigint) event_id, 'note: key is null' reason, cast(floor(epoch(ts)) as bigint) source_ts from events where event_id % 7 <> 1""")
def dlq(spark, d):
    rows = mapping.project(_event_docs(spark, d), STRICT, keep=("raw",))
    out = mapping.dead_letters(rows, "events", F.col("raw"))
    return out.select("job", F.get_json_object("payload", "$.id").cast("long").alias("event_id"), "reason", "source_ts")


LATEST_SQL = """select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn from events) where rn = 1 and event_type <> 'click'"""


@query(LATEST_SQL)
def cdc_latest(spark, d):
    last = mapping.latest(table(spark, d, "events"), ["user_id"], "ts", "event_id")
    return last.where("event_type <> 'click'").select("user_id", "event_id", "event_type", "value")


def _customers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, d, "customer").select("c_custkey", "c_name", cents("c_acctbal").alias("balance"), "c_mktsegment")
    over = c.where("c_custkey % 3 = 0").withColumn("c_custkey", F.expr("case when c_custkey % 2 = 0 then c_custkey else c_custkey + 1000000 end"))
    return c, over.select("c_custkey", F.expr("case when c_custkey % 5 = 0 then null else balance + 1 end").alias("balance"), F.lit("NEW").alias("c_mktsegment"))


MERGE_SQL = """with c as (select c_custkey, c_name, cast(round(c_acctbal * 100) as bigint) balance, c_mktsegment from customer),
o0 as (select case when c_custkey % 2 = 0 then c_custkey else c_custkey + 1000000 end c_custkey, balance from c where c_custkey % 3 = 0),
o as (select c_custkey, case when c_custkey % 5 = 0 then null else balance + 1 end balance, 'NEW' c_mktsegment from o0) """
_COLS = ["c_custkey", "c_name", "balance", "c_mktsegment"]


@query(MERGE_SQL + "select * from c union all select c_custkey, null, balance, c_mktsegment from o where c_custkey not in (select c_custkey from c)")
def merge_insert(spark, d):
    c, o = _customers(spark, d)
    return merge.insert(c, o, ["c_custkey"])[0].select(*_COLS)


@query(MERGE_SQL + "select c.c_custkey, c_name, case when o.c_custkey is null then c.balance else o.balance end balance, coalesce(o.c_mktsegment, c.c_mktsegment) c_mktsegment from c left join o on c.c_custkey = o.c_custkey")
def merge_update(spark, d):
    c, o = _customers(spark, d)
    return merge.update(c, o, ["c_custkey"])[0].select(*_COLS)


@query(MERGE_SQL + "select * from c where c_custkey not in (select c_custkey from o) union all select c_custkey, null, balance, c_mktsegment from o")
def merge_replace(spark, d):
    c, o = _customers(spark, d)
    return merge.replace(c, o, ["c_custkey"]).select(*_COLS)


@query(MERGE_SQL + "select coalesce(c.c_custkey, o.c_custkey) c_custkey, c_name, case when o.c_custkey is null then c.balance else o.balance end balance, coalesce(o.c_mktsegment, c.c_mktsegment) c_mktsegment from c full outer join o on c.c_custkey = o.c_custkey")
def merge_upsert(spark, d):
    c, o = _customers(spark, d)
    return merge.upsert(c, o, ["c_custkey"]).select(*_COLS)


@query(MERGE_SQL + "select * from c where c_custkey not in (select c_custkey from o)")
def merge_delete(spark, d):
    c, o = _customers(spark, d)
    return merge.delete(c, o, ["c_custkey"]).select(*_COLS)


@query(MERGE_SQL + "select 'insert' op, c_custkey from o where c_custkey in (select c_custkey from c) union all select 'update', c_custkey from o where c_custkey not in (select c_custkey from c)")
def merge_rejects(spark, d):
    c, o = _customers(spark, d)
    a, b = merge.insert(c, o, ["c_custkey"])[1], merge.update(c, o, ["c_custkey"])[1]
    return a.select(F.lit("insert").alias("op"), "c_custkey").unionByName(b.select(F.lit("update").alias("op"), "c_custkey"))


@query("select o_orderkey, o_custkey, o_orderstatus from orders where o_custkey in (select c_custkey from customer where c_nationkey = 3)")
def key_lookup(spark, d):
    keys = table(spark, d, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("o_custkey"))
    return by_keys(table(spark, d, "orders"), keys, ["o_custkey"]).select("o_orderkey", "o_custkey", "o_orderstatus")


# Shards

SHARD_SQL = "cast(list_reduce([0::bigint] || list_transform(range(0, 16), lambda i: cast(('0x' || substr(sha256({0}), i * 4 + 1, 4)) as bigint)), lambda a, b: (a * 65536 + b) % {1}) as bigint)"


@query(f"select event_id, {SHARD_SQL.format('cast(event_id as varchar)', 7)} shard from events")
def shard_assign(spark, d):
    return table(spark, d, "events").select("event_id", text.stable_shard(F.col("event_id"), 7).alias("shard"))


@query(f"select {SHARD_SQL.format('cast(event_id as varchar)', 7)} shard, count(*) n_rows, min(event_id) first_id from events group by 1")
def shard_counts(spark, d):
    return table(spark, d, "events").groupBy(text.stable_shard(F.col("event_id"), 7).alias("shard")).agg(F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_id"))


@query(f"select event_id from (select event_id from events order by event_id limit 500) where {SHARD_SQL.format('cast(event_id as varchar)', 4)} = 1")
def limit_then_shard(spark, d):
    return table(spark, d, "events").select("event_id").orderBy("event_id").limit(500).where(text.stable_shard(F.col("event_id"), 4) == 1)


@query(f"""with a as (select r_name, cast(unnest(range(0, 4)) as int) shard, {SHARD_SQL.format("r_name || ':worker-a'", 4)} off from region)
select r_name, shard, 'v1:' || r_name || ':shard=' || shard work_key, cast((shard - off + 4) % 4 as bigint) place from a""")
def shard_plan(spark, d):
    return control.shard_plan(table(spark, d, "region").select("r_name"), "r_name", 4, "worker-a")


# Incremental

@query("""with a as (select event_id, cast(floor(epoch(ts)) as bigint) e, event_id % 97 = 5 f from events), b as (select cast(floor(min(e) + (max(e) - min(e)) / 2) as bigint) w from a)
select count(*) n_rows, min(a.e) - max(b.w) > -5 strict, max(e) max_seen, max(case when not f then e end) max_success, count(*) filter (f) failures, greatest(0, max(e) - max(case when not f then e end)) lag from a, b where a.e > b.w - 5""")
def inc_v1(spark, d):
    a = table(spark, d, "events").select("event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("e"), F.expr("event_id % 97 = 5").alias("f"))
    lo, hi = a.agg(F.min("e"), F.max("e")).first()
    w = lo + (hi - lo) // 2
    rows = incremental.after(a, "e", w, 5)
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), (F.min("e") - F.lit(w) > -5).alias("strict"), F.max("e").alias("max_seen"), F.max(F.when(~F.col("f"), F.col("e"))).alias("max_success"),
        F.count_if("f").alias("failures"), F.greatest(F.lit(0).cast("long"), F.max("e") - F.max(F.when(~F.col("f"), F.col("e")))).alias("lag"),
    )


TIED_SQL = "(select o_orderdate from orders group by 1 order by count(*) desc, 1 limit 1)"


def _tied(spark: SparkSession, d: str):
    return table(spark, d, "orders").groupBy("o_orderdate").count().orderBy(F.desc("count"), "o_orderdate").first()[0]


@query(f"select o_orderkey, o_orderdate from orders where o_orderdate >= {TIED_SQL} and not (o_orderdate = {TIED_SQL} and o_orderkey % 2 = 0)")
def inc_v2_resume(spark, d):
    o, at = table(spark, d, "orders").select("o_orderkey", "o_orderdate"), F.lit(_tied(spark, d))
    seen = o.where((F.col("o_orderdate") == at) & F.expr("o_orderkey % 2 = 0")).select("o_orderkey")
    return incremental.resume(o, "o_orderdate", at, "o_orderkey", seen)


@query("select o_orderdate watermark, string_agg(cast(o_orderkey as varchar), ',' order by cast(o_orderkey as varchar)) keys, count(*) n_keys from orders where o_orderdate = (select max(o_orderdate) from orders) group by 1")
def inc_checkpoint(spark, d):
    return incremental.checkpoint(table(spark, d, "orders"), "o_orderdate", "o_orderkey")


@query("""with a as (select event_type, event_id e, event_id % 97 = 5 and event_type <> 'click' f from events), g as (select event_type, count(*) filter (f) failures, max(e) max_seen, max(case when not f then e end) max_success from a group by 1)
select *, case when failures = 0 then greatest(100, max_success) else 100 end watermark, greatest(0, max_seen - coalesce(max_success, 0)) lag from g""")
def inc_hold(spark, d):
    e = table(spark, d, "events")
    return incremental.held(e, ["event_type"], "event_id", F.expr("event_id % 97 = 5 and event_type <> 'click'"), F.lit(100).cast("long"))


@query("select * from (values ('a', 12::bigint, 'scoped'), ('b', 7::bigint, 'plain'), ('c', 0::bigint, 'none')) t(job, watermark, origin)")
def wm_legacy(spark, d):
    jobs = values(spark, "job string, scoped string, plain string", [("a", "v1:a->A", "a"), ("b", "v1:b->B", "b"), ("c", "v1:c->C", "c")])
    return incremental.with_fallback(jobs, values(spark, "key string, watermark long", [("v1:a->A", 12), ("a", 7), ("b", 7)]))


@query("select s_nationkey::varchar as key, max(s_suppkey) watermark from supplier where s_suppkey % 3 <> 0 group by 1")
def wm_merge_max(spark, d):
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("key"), F.expr("s_suppkey % 3").alias("m")).agg(F.max("s_suppkey").alias("watermark"))
    return incremental.merge_max(s.where("m = 1").drop("m"), s.where("m = 2").drop("m"))


@query("""with s as (select s_nationkey::varchar as key, s_suppkey % 2 side, max(s_suppkey // 50) watermark, list(distinct 'k' || (s_suppkey % 4)) keys from supplier group by 1, 2),
t as (select key, max(watermark) watermark from s group by 1) select s.key, s.watermark, array_to_string(list_sort(list_distinct(flatten(list(keys)))), ',') as keys from s join t on s.key = t.key and s.watermark = t.watermark group by 1, 2""")
def wm_merge_ties(spark, d):
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("key"), F.expr("s_suppkey % 2").alias("side")).agg(F.max(F.expr("s_suppkey div 50")).alias("watermark"), F.collect_set(F.expr("concat('k', s_suppkey % 4)")).alias("keys"))
    out = incremental.merge_ties(s.where("side = 0").drop("side"), s.where("side = 1").drop("side"))
    return out.withColumn("keys", F.array_join("keys", ","))


@query("""with s as (select s_nationkey::varchar as key, s_name as val, s_suppkey % 5 as written, s_suppkey % 2 side, row_number() over (partition by s_nationkey, s_suppkey % 2 order by s_suppkey) rn from supplier)
select key, val, written from (select *, row_number() over (partition by key order by written desc, side desc) r from s where rn = 1) where r = 1""")
def state_lww(spark, d):
    s = mapping.latest(table(spark, d, "supplier").select(F.col("s_nationkey").cast("string").alias("key"), F.col("s_name").alias("val"), F.expr("s_suppkey % 5").alias("written"), F.expr("s_suppkey % 2").alias("side"), F.expr("-s_suppkey").alias("o")), ["key", "side"], "o").drop("o")
    return incremental.merge_last(s.where("side = 0").drop("side"), s.where("side = 1").drop("side"), "val", "written")


ARRIVAL_SQL = "with a as (select event_id, event_type, md5(cast(event_id as varchar)) arrival from events) "


def _arrivals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "event_type", F.md5(F.col("event_id").cast("string").cast("binary")).alias("arrival"))


@query(ARRIVAL_SQL + """, b as (select *, event_id < greatest(50, max(event_id) over (partition by event_type order by arrival rows between unbounded preceding and 1 preceding)) late from a)
select event_type, count(*) filter (late) late_rows, count(*) n_rows from b group by 1""")
def out_of_order(spark, d):
    rows = incremental.disorder(_arrivals(spark, d), ["event_type"], "arrival", "event_id", 50)
    return rows.groupBy("event_type").agg(F.count_if("late").alias("late_rows"), F.count(F.lit(1)).alias("n_rows"))


@query(ARRIVAL_SQL + """select event_type, event_id, arrival from (select *, max(event_id) over (partition by event_type order by arrival rows between unbounded preceding and 1 preceding) m from a) where m is null or event_id > m""")
def monotone_reader(spark, d):
    return incremental.rising(_arrivals(spark, d), ["event_type"], "arrival", "event_id", "event_id").select("event_type", "event_id", "arrival")


@query("""with a as (select user_id, event_id, event_id % 97 = 5 f from events), b as (select user_id, min(event_id) m from a where f group by 1)
select a.user_id, max(case when not f then event_id end) last_success, max(case when m is null or event_id < m then event_id end) resume_at from a left join b on a.user_id = b.user_id group by 1""")
def resume_position(spark, d):
    return incremental.positions(table(spark, d, "events").select("user_id", "event_id"), ["user_id"], "event_id", F.expr("event_id % 97 = 5"))


# Routing

ROUTED_SQL = """with r as (select doc_id, 'docs|' || doc_id route_key, strlen(coalesce(text, ''))::bigint size, sha256(coalesce(text, '')) checksum from documents),
rec as (select *, case when size + 64 < 2000 then 'document' when size + 64 <= 8000 then 'relational' else 'reject' end destination from r),
reg as (select route_key, case when doc_id % 5 = 1 then case destination when 'document' then 'relational' else 'document' end when destination = 'reject' then 'document' else destination end destination,
  case when doc_id % 3 = 0 then 'old' else checksum end checksum, size, 't0' updated_at, case when doc_id % 4 = 2 then 'pending_cleanup' else 'complete' end sync_state, case when doc_id % 4 = 2 then 'relational' end cleanup_from from rec where doc_id % 6 <> 5),
acted as (select rec.*, reg.destination old_destination, reg.sync_state old_state, reg.cleanup_from old_cleanup, case when rec.destination = 'reject' then 'reject' when reg.destination = rec.destination and reg.checksum = rec.checksum and reg.sync_state = 'pending_cleanup' then 'finalize'
  when reg.destination = rec.destination and reg.checksum = rec.checksum then 'skip' when reg.destination is null then 'insert' when reg.destination = rec.destination then 'update' else 'move' end as action from rec left join reg on rec.route_key = reg.route_key) """


def _records(spark: SparkSession, d: str) -> DataFrame:
    t = F.coalesce(F.col("text"), F.lit(""))
    r = table(spark, d, "documents").select("doc_id", text.route_key(F.lit("docs"), text.source_key(F.col("doc_id"))).alias("route_key"), text.json_bytes(t).alias("size"), text.checksum(t).alias("checksum"))
    return r.withColumn("destination", routing.destination(F.col("size"), 2000, 8000, 64))


def _registry(rec: DataFrame) -> DataFrame:
    return rec.where("doc_id % 6 <> 5").selectExpr(
        "route_key",
        "case when doc_id % 5 = 1 then case destination when 'document' then 'relational' else 'document' end when destination = 'reject' then 'document' else destination end as destination",
        "case when doc_id % 3 = 0 then 'old' else checksum end as checksum",
        "size",
        "'t0' as updated_at",
        "case when doc_id % 4 = 2 then 'pending_cleanup' else 'complete' end as sync_state",
        "case when doc_id % 4 = 2 then 'relational' end as cleanup_from",
    )


@query(ROUTED_SQL + "select doc_id, size, destination, (size + 64) || case destination when 'document' then ' bytes < 2000' when 'relational' then ' bytes in [2000, 8000]' else ' bytes > 8000' end reason from rec")
def route_size(spark, d):
    return _records(spark, d).select("doc_id", "size", "destination", routing.reason(F.col("size"), 2000, 8000, 64).alias("reason"))


@query(ROUTED_SQL + "select route_key, destination, old_destination, action from acted")
def route_actions(spark, d):
    rec = _records(spark, d)
    return routing.actions(rec, _registry(rec)).select("route_key", "destination", "old_destination", "action")


@query(ROUTED_SQL + """, ch as (select route_key, destination, checksum, size, 't1' updated_at, case when action in ('move', 'finalize') and doc_id % 10 = 6 then 'pending_cleanup' else 'complete' end sync_state,
case when action in ('move', 'finalize') and doc_id % 10 = 6 then case when action = 'move' then old_destination else old_cleanup end end cleanup_from from acted where action not in ('reject', 'skip'))
select * from reg where route_key not in (select route_key from ch) union all select * from ch""")
def route_next_registry(spark, d):
    rec = _records(spark, d)
    reg = _registry(rec)
    return routing.next_registry(routing.actions(rec, reg), reg, F.expr("doc_id % 10 = 6"), F.lit("t1"))


@query(ROUTED_SQL + """select destination, count(*) records, count(*) filter (action = 'reject') n_reject, count(*) filter (action = 'finalize') n_finalize, count(*) filter (action = 'skip') n_skip, count(*) filter (action = 'insert') n_insert,
count(*) filter (action = 'update') n_update, count(*) filter (action = 'move') n_move, count(*) filter (destination = 'document' and action in ('insert', 'update', 'move')) document_writes, count(*) filter (destination = 'relational' and action in ('insert', 'update', 'move')) relational_writes,
0::bigint checkpoint_skipped, 0::bigint out_of_order, 0::bigint failed, 0::bigint cleanup_failed from acted group by 1""")
def route_statistics(spark, d):
    rec = _records(spark, d)
    return routing.statistics(routing.actions(rec, _registry(rec)), ["destination"])


@query(ROUTED_SQL + """select 'upsert' op, destination sink, count(*) n_rows from acted where action in ('insert', 'update', 'move') group by 2 union all
select 'delete', sink, count(*) from (select old_destination sink from acted where action = 'move' union all select old_cleanup from acted where action = 'finalize' and old_cleanup is not null) group by 2""")
def route_writes(spark, d):
    rec = _records(spark, d)
    w = routing.writes(routing.actions(rec, _registry(rec)))
    up = w["upsert"].groupBy(F.col("destination").alias("sink")).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("upsert").alias("op"), "sink", "n_rows")
    return up.unionByName(w["delete"].groupBy("sink").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("delete").alias("op"), "sink", "n_rows"))


@query(ROUTED_SQL + """, e as (select route_key k, doc_id, sha256(destination || '|' || checksum) rd, sha256(checksum || '|' || size) wd from rec where destination <> 'reject'),
g as (select case when doc_id % 23 = 0 then 'x' || k else k end k, case when doc_id % 29 = 0 then 'bad' else rd end d, case when doc_id % 31 = 0 then 'pending_cleanup' else 'complete' end st from e where doc_id % 19 <> 0),
t as (select case when doc_id % 13 = 0 then 'y' || k else k end k, case when doc_id % 11 = 0 then 'bad' else wd end d, doc_id % 37 = 0 stale from e where doc_id % 17 <> 0),
ks as (select k from e union select k from g union select k from t), m as (select e.rd, e.wd, g.d gd, g.st, t.d td, t.stale from ks left join e on ks.k = e.k left join g on ks.k = g.k left join t on ks.k = t.k)
select count(rd) source_rows, count(gd) registry_rows, count(td) target_rows, count(*) filter (rd is not null and gd is null) missing_registry, count(*) filter (rd is null and gd is not null) extra_registry, count(*) filter (rd <> gd) mismatched_registry,
count(*) filter (rd is not null and td is null) missing_target, count(*) filter (rd is null and td is not null) extra_target, count(*) filter (wd <> td) mismatched_target, count(*) filter (st = 'pending_cleanup') pending_cleanup, count(*) filter (stale) metadata_mismatches from m""")
def recon3_summary(spark, d):
    e = _records(spark, d).where("destination <> 'reject'").select("doc_id", F.col("route_key").alias("key"), F.expr("sha2(concat(destination, '|', checksum), 256)").alias("route_digest"), F.expr("sha2(concat(checksum, '|', size), 256)").alias("row_digest"))
    g = e.where("doc_id % 19 <> 0").selectExpr("case when doc_id % 23 = 0 then concat('x', key) else key end as key", "case when doc_id % 29 = 0 then 'bad' else route_digest end as digest", "case when doc_id % 31 = 0 then 'pending_cleanup' else 'complete' end as sync_state")
    t = e.where("doc_id % 17 <> 0").selectExpr("case when doc_id % 13 = 0 then concat('y', key) else key end as key", "case when doc_id % 11 = 0 then 'bad' else row_digest end as digest", "doc_id % 37 = 0 as stale")
    return reconcile.three_way_summary(reconcile.three_way(e, g, t))


@query("""with k as (select doc_id, case doc_id % 4 when 0 then 'a|' || doc_id when 1 then 'a|b|' || doc_id when 2 then 'a|bc|' || doc_id else 'z|' || doc_id end route_key from documents), n as (select * from (values ('a', 'job-a'), ('a|b', 'job-ab'), ('q', 'job-q')) t(namespace, job))
select route_key, (select arg_max(job, length(namespace)) from n where k.route_key = namespace or starts_with(k.route_key, namespace || '|')) job from k""")
def prefix_owner(spark, d):
    k = table(spark, d, "documents").select(F.expr("case doc_id % 4 when 0 then concat('a|', doc_id) when 1 then concat('a|b|', doc_id) when 2 then concat('a|bc|', doc_id) else concat('z|', doc_id) end").alias("route_key"))
    return routing.owners(k, values(spark, "namespace string, job string", [("a", "job-a"), ("a|b", "job-ab"), ("q", "job-q")]))


# Control tables

WORK_SQL = """with w as (select 'v1:t' || s_suppkey || ':shard=0' work_key, s_suppkey from supplier),
p as (select work_key, case s_suppkey % 4 when 0 then 'running' when 1 then 'completed' when 2 then 'failed' else 'running' end status from w where s_suppkey % 5 <> 0),
l as (select work_key, case s_suppkey % 3 when 0 then '2026-01-01 00:00:00' when 1 then '2026-06-01 00:00:00' else '' end expires_at from w where s_suppkey % 7 <> 0),
o as (select w.work_key, coalesce(status, 'pending') status, cast(case coalesce(status, 'pending') when 'failed' then 0 when 'pending' then 1 when 'running' then 2 else 3 end as int) status_rank,
 cast(list_sum(list_transform(string_split('worker-a:' || w.work_key, ''), lambda c: ascii(c))) % 1024 as bigint) worker_rank from w left join p on w.work_key = p.work_key) """


def _now() -> Column:
    return F.lit("2026-03-01 00:00:00").cast("timestamp")


def _work(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    w = table(spark, d, "supplier").select(F.expr("concat('v1:t', s_suppkey, ':shard=0')").alias("work_key"), "s_suppkey")
    p = w.where("s_suppkey % 5 <> 0").select("work_key", F.expr("case s_suppkey % 4 when 0 then 'running' when 1 then 'completed' when 2 then 'failed' else 'running' end").alias("status"))
    leases = w.where("s_suppkey % 7 <> 0").select("work_key", F.expr("case s_suppkey % 3 when 0 then '2026-01-01 00:00:00' when 1 then '2026-06-01 00:00:00' else '' end").alias("expires_at"))
    return w.select("work_key"), p, leases


@query(WORK_SQL + "select p.work_key from p left join l on p.work_key = l.work_key where status = 'running' and (expires_at is null or coalesce(try_cast(expires_at as timestamp) <= timestamp '2026-03-01', true))")
def stale_work(spark, d):
    _, p, leases = _work(spark, d)
    return control.stale(p, leases, _now()).select("work_key")


@query(WORK_SQL + "select * from o")
def work_order(spark, d):
    w, p, _ = _work(spark, d)
    return control.work_order(w, p, "worker-a")


@query(WORK_SQL + "select status, count(*) n_items, bool_or(status = 'failed') any_failed from o group by 1")
def work_status(spark, d):
    w, p, _ = _work(spark, d)
    return control.work_order(w, p, "worker-a").groupBy("status").agg(F.count(F.lit(1)).alias("n_items"), F.bool_or(F.col("status") == "failed").alias("any_failed"))


@query(WORK_SQL + "select work_key, worker_rank from o where status = 'failed' order by worker_rank, work_key limit 5")
def failed_work(spark, d):
    w, p, _ = _work(spark, d)
    return control.work_order(w, p, "worker-a").where("status = 'failed'").orderBy("worker_rank", "work_key").limit(5).select("work_key", "worker_rank")


@query(WORK_SQL + "select work_key, status from o where status <> 'completed' and work_key not in (select work_key from l where not coalesce(try_cast(expires_at as timestamp) <= timestamp '2026-03-01', true)) order by status_rank, worker_rank, work_key limit 1")
def claim_next(spark, d):
    w, p, leases = _work(spark, d)
    return control.claim(control.work_order(w, p, "worker-a"), leases, _now()).select("work_key", "status")


@query(WORK_SQL + "select work_key from w where work_key not in (select work_key from p where status = 'completed')")
def skip_completed(spark, d):
    w, p, _ = _work(spark, d)
    return w.join(p.where("status = 'completed'"), "work_key", "left_anti")


STATUS_SQL = "case event_id % 3 when 0 then 'running' when 1 then 'failed' else 'completed' end"


@query(f"with a as (select user_id, ts, event_id, {STATUS_SQL} s from events) select user_id, count(*) filter (s = 'running') attempt_count, arg_max(s, event_id) status, count(*) n_events from a group by 1")
def attempt_fold(spark, d):
    return control.attempts(table(spark, d, "events").withColumn("s", F.expr(STATUS_SQL)), "user_id", "s", ["ts", "event_id"])


@query("""select * from (values ('a', cast(null as varchar), true), ('b', 'not passed', false), ('c', 'fingerprint differs', false), ('d', 'bad timestamp', false), ('e', 'older than allowed', false), ('f', 'checks missing', false), ('g', 'absent', false)) t(scope, failure, passed)""")
def gate_verify(spark, d):
    rows = values(spark, "scope string, status string, fingerprint string, attested_at string, checks array<string>", [
        ("a", "passed", "f1", "2026-02-28 00:00:00", ["x", "y", "z"]), ("b", "failed", "f1", "2026-02-28 00:00:00", ["x", "y"]), ("c", "passed", "f2", "2026-02-28 00:00:00", ["x", "y"]),
        ("d", "passed", "f1", "soon", ["x", "y"]), ("e", "passed", "f1", "2026-02-20 00:00:00", ["x", "y"]), ("f", "passed", "f1", "2026-02-28 00:00:00", ["x"]), ("g", None, None, None, None),
    ])
    return control.gate(rows, "f1", ["x", "y"], _now(), 48).select("scope", "failure", "passed")


@query("select * from (values ('t', 'b'), ('u', 'a')) t(table_name, column_name)")
def schema_diff(spark, d):
    kind = "table_name string, column_name string"
    return control.schema_diff(values(spark, kind, [("t", "a"), ("t", "b"), ("u", "a")]), values(spark, kind, [("t", "a"), ("t", "c"), ("u", "b")]))


@query("select cast(i as int) attempt, least(15.0, 0.5 * pow(2.0, i - 1))::double delay from range(1, 9) t(i)")
def retry_schedule(spark, d):
    return spark.range(1, 9).select(F.col("id").cast("int").alias("attempt")).withColumn("delay", control.retry_delay(F.col("attempt"), 0.5, 15.0, 2.0))


# Metrics

@query("select event_type, count(value) obs_count, cast(sum(cast(round(value * 100) as bigint)) as bigint) obs_sum, max(cast(round(value * 100) as bigint)) obs_max from events group by 1")
def metrics_rollup(spark, d):
    return metrics.rollup(table(spark, d, "events").withColumn("v", cents("value")), ["event_type"], "v")


@query("""with s as (select event_type, count(*)::varchar v from events group by 1) select 'metric_1rows_seen' as name, 0 part, '# HELP metric_1rows_seen metric_1rows_seen' line union all select 'metric_1rows_seen', 1, '# TYPE metric_1rows_seen gauge'
union all select 'metric_1rows_seen', 2, 'metric_1rows_seen{type="' || event_type || '\\"q\\\\"} ' || v || '.0' from s""")
def prom_text(spark, d):
    s = table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).cast("double").alias("value"))
    samples = s.select(F.lit("1rows-seen").alias("name"), F.lit("gauge").alias("kind"), F.create_map(F.lit("type"), F.concat("event_type", F.lit('"q\\'))).alias("labels"), "value", F.lit(1).alias("at"), F.lit("").alias("description"))
    return metrics.text_lines(metrics.collected(samples))


# Streaming

@query(LATEST_SQL)
def stream_cdc(spark, d):
    """The change stream drained by Structured Streaming; must equal cdc_latest."""
    from tidemark.plans.transfer import scratch

    run = scratch(spark)
    schema = table(spark, d, "events").schema
    source = streams.file_changes(spark, d, schema, "events.parquet").withColumn("gone", F.expr("event_type = 'click'"))
    live = streams.run_changes(source, f"{run}/table", f"{run}/checkpoint", ["user_id"], ["ts", "event_id"], "gone")
    return live.select("user_id", "event_id", "event_type", "value")
