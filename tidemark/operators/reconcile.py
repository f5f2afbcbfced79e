"""Two-way and three-way reconciliation by digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import row_digest
from tidemark.operators.routing import REJECT, owners


def classified(source: DataFrame, target: DataFrame) -> DataFrame:
    """Inputs key_text, digest. key_text, source_digest, target_digest, status: missing, extra, mismatched or equal.

    One shuffle on the key: both sides are unioned and grouped, so a key's rows meet pre-aggregated and no join sorts them.
    A key that several rows of one side share counts once there, by its largest digest; `repeated_keys` finds these.
    """
    none = F.lit(None).cast("string")
    both = source.select("key_text", F.col("digest").alias("s"), none.alias("t")).unionByName(target.select("key_text", none.alias("s"), F.col("digest").alias("t")))
    met = both.groupBy("key_text").agg(F.max("s").alias("source_digest"), F.max("t").alias("target_digest"))
    status = F.when(F.col("target_digest").isNull(), "missing").when(F.col("source_digest").isNull(), "extra").when(F.col("source_digest") != F.col("target_digest"), "mismatched").otherwise("equal")
    return met.withColumn("status", status)


def summary(rows: DataFrame) -> DataFrame:
    """All counts in one aggregate."""
    s, t = F.col("source_digest"), F.col("target_digest")
    return rows.agg(
        F.count(s).alias("source_rows"),
        F.count(t).alias("target_rows"),
        F.count_if(F.col("status") == "missing").alias("missing_rows"),
        F.count_if(F.col("status") == "extra").alias("extra_rows"),
        F.count_if(F.col("status") == "mismatched").alias("mismatched_rows"),
    )


def fold(key: Column, digest: Column) -> Column:
    """Aggregate: sha256 over key|digest lines in key order. Holds a group's lines in memory; see bucket_folds."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), digest.alias("d")))), lambda x: F.concat(x["k"], F.lit("|"), x["d"], F.lit("\n")))
    return F.sha2(F.array_join(lines, ""), 256)


def repeated_keys(rows: DataFrame) -> DataFrame:
    """key_text and n_rows of the keys that several rows share."""
    return rows.groupBy("key_text").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def fold_digits(rows: int, most: int = 50_000) -> int:
    """Digits of bucket_folds that keep a bucket under `most` rows on average."""
    digits = 1
    while rows > most * 16**digits:
        digits += 1
    return digits


def bucket_folds(rows: DataFrame, by: list[str], digits: int = 2) -> DataFrame:
    """A checksum for tables of any size: ordered folds of 16**digits key buckets, folded again digit by digit, so that no step holds more than a bucket or sixteen folds. Another value than `fold`."""
    bucket = F.left(F.sha2(F.col("key_text"), 256), F.lit(digits))
    parts = rows.withColumn("_b", bucket).groupBy(*by, "_b").agg(fold(F.col("key_text"), F.col("digest")).alias("_d"), F.count(F.lit(1)).alias("_n"))
    for n in range(digits - 1, 0, -1):
        parts = parts.withColumn("_up", F.left("_b", F.lit(n))).groupBy(*by, "_up").agg(fold(F.col("_b"), F.col("_d")).alias("_d"), F.sum("_n").alias("_n")).withColumnRenamed("_up", "_b")
    return parts.groupBy(*by).agg(F.sum("_n").alias("n_rows"), fold(F.col("_b"), F.col("_d")).alias("checksum"))


def additive(rows: DataFrame, by: list[str]) -> DataFrame:
    """Order-free checksum of constant memory: xor of row hashes and a count."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(F.xxhash64("key_text", "digest")).alias("checksum"))


def sample_compare(source: DataFrame, target: DataFrame, key: str, cols: list[str], n: int) -> DataFrame:
    """Sampled validation: the first n live rows by key of a scan of 5n, looked up in the target."""
    sample = source.orderBy(key).limit(5 * n).where("not is_delete and error is null").orderBy(key).limit(n)
    t = target.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in cols])
    met = F.broadcast(sample).join(t, F.col(key) == F.col("_k"), "left")  # n rows
    differs = [(~F.col(c).eqNullSafe(F.col(f"_{c}"))).cast("long") for c in cols]
    fields = sum(differs[1:], differs[0])
    found = F.col("_k").isNotNull()
    return met.agg(
        F.count(F.lit(1)).alias("sampled"),
        F.count_if(~found).alias("missing_keys"),
        F.coalesce(F.sum(F.when(found, fields)), F.lit(0)).alias("field_mismatches"),
        F.count_if(found & (fields > 0)).alias("row_mismatches"),
    )


def three_way(expected: DataFrame, registry: DataFrame, target: DataFrame) -> DataFrame:
    """Inputs: expected key, route_digest, row_digest; registry key, digest, sync_state; target key, digest, stale. One shuffle for all three."""
    s, b = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    none = {"route_digest": s, "row_digest": s, "registry_digest": s, "sync_state": s, "target_digest": s, "stale": b}

    def side(df: DataFrame, **cols: str) -> DataFrame:
        return df.select("key", *[(F.col(cols[n]) if n in cols else v).alias(n) for n, v in none.items()])

    rows = side(expected, route_digest="route_digest", row_digest="row_digest").unionByName(side(registry, registry_digest="digest", sync_state="sync_state")).unionByName(side(target, target_digest="digest", stale="stale"))
    return rows.groupBy("key").agg(*[F.max(n).alias(n) for n in none])


def three_way_summary(rows: DataFrame) -> DataFrame:
    e, r, t, w = F.col("route_digest"), F.col("registry_digest"), F.col("target_digest"), F.col("row_digest")
    return rows.agg(
        F.count(e).alias("source_rows"),
        F.count(r).alias("registry_rows"),
        F.count(t).alias("target_rows"),
        F.count_if(e.isNotNull() & r.isNull()).alias("missing_registry"),
        F.count_if(e.isNull() & r.isNotNull()).alias("extra_registry"),
        F.count_if(e != r).alias("mismatched_registry"),
        F.count_if(e.isNotNull() & t.isNull()).alias("missing_target"),
        F.count_if(e.isNull() & t.isNotNull()).alias("extra_target"),
        F.count_if(w != t).alias("mismatched_target"),
        F.count_if(F.col("sync_state") == "pending_cleanup").alias("pending_cleanup"),
        F.count_if(F.col("stale")).alias("metadata_mismatches"),
    )


#: Columns that a record's route and its stored row are compared by.
ROUTE_COLUMNS = ["destination", "checksum", "payload_size_bytes"]
ROW_COLUMNS = ["destination", "source_job", "source_api", "source_namespace", "source_key", "checksum", "payload_size_bytes", "event_ts"]


def _digest(df: DataFrame, columns: list[str]) -> Column:
    kinds = dict(df.dtypes)
    return row_digest([(c, kinds[c]) for c in columns])


def validate_routed(records: DataFrame, registry: DataFrame, stored: DataFrame, namespaces: DataFrame, *, compare_event_ts: bool = True, digits: int = 2) -> DataFrame:
    """The whole validation of a routed copy, a row per job: ten counts, rejected and stale rows, and four checksums.

    records: envelopes with destination, the expected state. registry: route_key, destination, checksum, size, sync_state.
    stored: what the sinks read back (see sources.sinks). namespaces: namespace, job; a route key belongs to the job of the
    longest namespace it begins with, keys of no job are left out. Without event_ts where the source has none of its own.
    Equal sides have equal checksums: ordered folds of key and digest, in buckets so that any size fits.
    """
    row_columns = [c for c in ROW_COLUMNS if compare_event_ts or c != "event_ts"]
    none, flag = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    blank = {"route_digest": none, "row_digest": none, "registry_digest": none, "sync_state": none, "target_digest": none, "stale": flag, "rejected": flag}

    def side(df: DataFrame, **cols: Column) -> DataFrame:
        return df.select("route_key", *[(cols[n] if n in cols else v).alias(n) for n, v in blank.items()])

    live = F.col("destination") != REJECT
    reg = registry.withColumnRenamed("size", "payload_size_bytes")
    met = (
        side(records, route_digest=F.when(live, _digest(records, ROUTE_COLUMNS)), row_digest=F.when(live, _digest(records, row_columns)), rejected=~live)
        .unionByName(side(reg, registry_digest=_digest(reg, ROUTE_COLUMNS), sync_state=F.col("sync_state")))
        .unionByName(side(stored, target_digest=_digest(stored, row_columns), stale=F.col("stale")))
    )
    keyed = met.groupBy("route_key").agg(*[F.max(n).alias(n) for n in blank])
    rows = owners(keyed.select("route_key"), namespaces).join(keyed, "route_key").where("job is not null")
    e, r, t, w = F.col("route_digest"), F.col("registry_digest"), F.col("target_digest"), F.col("row_digest")
    counts = rows.groupBy("job").agg(
        F.count(e).alias("source_count"),
        F.count(r).alias("registry_count"),
        F.count(t).alias("target_count"),
        F.count_if("rejected").alias("source_rejected_rows"),
        F.count_if(e.isNotNull() & r.isNull()).alias("missing_registry_rows"),
        F.count_if(e.isNull() & r.isNotNull()).alias("extra_registry_rows"),
        F.count_if(e != r).alias("mismatched_registry_rows"),
        F.count_if(e.isNotNull() & t.isNull()).alias("missing_target_rows"),
        F.count_if(e.isNull() & t.isNotNull()).alias("extra_target_rows"),
        F.count_if(w != t).alias("mismatched_target_rows"),
        F.count_if(F.col("sync_state") == "pending_cleanup").alias("pending_cleanup_rows"),
        F.count_if("stale").alias("target_metadata_mismatches"),
    )
    sides = {"source_route_checksum": "route_digest", "registry_checksum": "registry_digest", "source_target_checksum": "row_digest", "target_checksum": "target_digest"}
    long = rows.select("job", F.col("route_key").alias("key_text"), F.expr(f"stack(4, {', '.join(f"'{k}', {v}" for k, v in sides.items())}) as (side, digest)")).where("digest is not null")
    sums = bucket_folds(long, ["job", "side"], digits).groupBy("job").agg(*[F.max(F.when(F.col("side") == k, F.col("checksum"))).alias(k) for k in sides])
    out = namespaces.select("job").distinct().join(counts, "job", "left").join(sums, "job", "left")
    return out.na.fill(0).withColumn("passed", F.expr("missing_registry_rows + extra_registry_rows + mismatched_registry_rows + missing_target_rows + extra_target_rows + mismatched_target_rows + pending_cleanup_rows + target_metadata_mismatches = 0"))


def validate_plain(source: DataFrame, target: DataFrame, *, digits: int = 2) -> DataFrame:
    """Validation by checksums in one row: the counts of `summary`, a checksum of either side and whether all agree. Inputs key_text, digest."""
    rows = classified(source, target)
    long = rows.select("key_text", F.expr("stack(2, 'source', source_digest, 'target', target_digest) as (side, digest)")).where("digest is not null")
    sums = bucket_folds(long, ["side"], digits).agg(*[F.max(F.when(F.col("side") == n, F.col("checksum"))).alias(f"{n}_checksum") for n in ("source", "target")])
    out = summary(rows).join(F.broadcast(sums))  # one row each
    return out.withColumn("passed", F.expr("missing_rows + extra_rows + mismatched_rows = 0 and source_checksum <=> target_checksum"))


def count_check(source: DataFrame, target: DataFrame, deleted: Column, failed: Column) -> DataFrame:
    """source_rows, expected_rows (neither deleted nor failed), target_rows and their difference."""
    a = source.agg(F.count(F.lit(1)).alias("source_rows"), F.count_if(~F.coalesce(deleted, F.lit(False)) & ~F.coalesce(failed, F.lit(False))).alias("expected_rows"))
    b = target.agg(F.count(F.lit(1)).alias("target_rows"))
    return a.join(F.broadcast(b)).withColumn("delta", F.col("target_rows") - F.col("expected_rows"))  # one row each
