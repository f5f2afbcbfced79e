"""Work plans, progress and leases, release gates and schema checks as queries over control tables."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shard_plan(jobs: DataFrame, name: str, shards: int, worker: str) -> DataFrame:
    """Every job by every shard, with the place of the shard in the worker's rotated order."""
    from tidemark.functions.text import stable_shard

    offset = stable_shard(F.concat(F.col(name), F.lit(":" + worker)), shards)
    rows = jobs.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    key = F.concat(F.lit("v1:"), F.col(name), F.lit(":shard="), F.col("shard").cast("string"))
    return rows.withColumn("work_key", key).withColumn("place", F.pmod(F.col("shard").cast("long") - offset, F.lit(shards).cast("long")))


def worker_rank(text: Column) -> Column:
    """Sum of code points modulo 1024."""
    return F.aggregate(F.split(text, ""), F.lit(0).cast("long"), lambda a, c: a + F.ascii(c)) % 1024


def work_key(pipeline: str, job: Column, shard: Column | None = None, target: Column | None = None) -> Column:
    """The name of a piece of work: v1:source->target or v2:job, with :shard=i where there are shards."""
    name = F.concat(F.lit(f"{pipeline}:"), job) if target is None else F.concat(F.lit(f"{pipeline}:"), job, F.lit("->"), target)
    return name if shard is None else F.concat(name, F.lit(":shard="), shard.cast("string"))


def progress_key(run: Column, work: Column) -> Column:
    return F.concat(run, F.lit(":"), work)


def expired(expiry: Column, now: Column) -> Column:
    """Blank or unreadable expiry times are over."""
    return F.coalesce(F.try_to_timestamp(expiry) <= now, F.lit(True))


def work_order(work: DataFrame, progress: DataFrame, worker: str) -> DataFrame:
    """work: work_key. Items without progress are pending; failed ones come first, then pending, running, completed."""
    rows = work.join(progress, "work_key", "left").withColumn("status", F.coalesce("status", F.lit("pending")))
    rank = F.when(F.col("status") == "failed", 0).when(F.col("status") == "pending", 1).when(F.col("status") == "running", 2).otherwise(3)
    return rows.withColumn("status_rank", rank).withColumn("worker_rank", worker_rank(F.concat(F.lit(worker + ":"), F.col("work_key"))))


def stale(progress: DataFrame, leases: DataFrame, now: Column) -> DataFrame:
    """Running items whose lease is gone or over."""
    met = progress.where("status = 'running'").join(leases, "work_key", "left")
    return met.where(F.col("expires_at").isNull() | expired(F.col("expires_at"), now))


def seeded(work: DataFrame, progress: DataFrame, now: Column) -> DataFrame:
    """Progress with a pending row for each item that has none; rows that are there stay as they are."""
    fresh = work.select("work_key").distinct().join(progress, "work_key", "left_anti").select("work_key", F.lit("pending").alias("status"), F.lit("").alias("owner_id"), F.lit(0).cast("long").alias("attempt_count"), F.lit("").alias("last_error"), now.alias("updated_at"))
    return progress.unionByName(fresh)


def reclaimed(progress: DataFrame, leases: DataFrame, now: Column) -> DataFrame:
    """Progress in which running items without a live lease have failed, with whose they were and since when; attempts stay."""
    gone = stale(progress.select("work_key", "status"), leases.select("work_key", "expires_at"), now).select("work_key", F.lit(True).alias("_stale"))
    rows = progress.join(gone, "work_key", "left")
    why = F.concat(F.lit("stale lease recovered previous_owner="), F.coalesce(F.nullif("owner_id", F.lit("")), F.lit("unknown")), F.lit(" updated_at="), F.coalesce(F.col("updated_at").cast("string"), F.lit("unknown")))
    hit = F.coalesce(F.col("_stale"), F.lit(False))
    return rows.select("work_key", F.when(hit, "failed").otherwise(F.col("status")).alias("status"), "owner_id", "attempt_count", F.when(hit, why).otherwise(F.col("last_error")).alias("last_error"), F.when(hit, now.cast(dict(progress.dtypes)["updated_at"])).otherwise(F.col("updated_at")).alias("updated_at"))


def leased(leases: DataFrame, wanted: DataFrame, owner: str, now: Column, seconds: int) -> DataFrame:
    """Leases after `owner` asks for the wanted items (work_key): its own are renewed, absent and expired ones taken, others' live ones left. granted tells which it holds."""
    both = leases.join(wanted.select("work_key", F.lit(True).alias("_asked")), "work_key", "full_outer")
    free = F.col("owner_id").isNull() | (F.col("owner_id") == owner) | expired(F.col("expires_at"), now)
    granted = F.coalesce(F.col("_asked") & free, F.lit(False))
    until = F.date_format(now + F.make_interval(secs=F.lit(seconds)), "yyyy-MM-dd HH:mm:ss")
    return both.select("work_key", F.when(granted, F.lit(owner)).otherwise(F.col("owner_id")).alias("owner_id"), F.when(granted, until).otherwise(F.col("expires_at")).alias("expires_at"), granted.alias("granted"))


def put_state(state: DataFrame, rows: DataFrame, now: Column) -> DataFrame:
    """Control rows (namespace, record_key, payload, status, owner_id, lease_expires_at, updated_at) written over by key, at the time of the commit."""
    new = rows.withColumn("updated_at", now).select(*state.columns)
    keys = ["namespace", "record_key"]
    return state.join(new.select(*keys), keys, "left_anti").unionByName(new)


def drop_state(state: DataFrame, keys: DataFrame) -> DataFrame:
    return state.join(keys.select("namespace", "record_key"), ["namespace", "record_key"], "left_anti")


def status_summary(work: DataFrame, progress: DataFrame, leases: DataFrame, now: Column, worker: str = "", first: int = 5) -> DataFrame:
    """One row: items, how many in each status, how many are stale, and the first failed ones."""
    rows = work_order(work, progress, worker)
    names = ("completed", "failed", "pending", "running")
    counts = rows.agg(F.count(F.lit(1)).alias("n_items"), *[F.count_if(F.col("status") == n).alias(f"n_{n}") for n in names])
    bad = rows.where("status = 'failed'").orderBy("worker_rank", "work_key").limit(first).agg(F.array_join(F.array_sort(F.collect_list("work_key")), ",").alias("first_failed"))
    gone = stale(progress, leases, now).agg(F.count(F.lit(1)).alias("n_stale"))
    return counts.join(F.broadcast(gone)).join(F.broadcast(bad))  # one row each


def claim(ordered: DataFrame, leases: DataFrame, now: Column) -> DataFrame:
    """The next item that isn't completed and that no live lease holds."""
    live = leases.where(~expired(F.col("expires_at"), now)).select("work_key")
    return ordered.where("status <> 'completed'").join(live, "work_key", "left_anti").orderBy("status_rank", "worker_rank", "work_key").limit(1)


def attempts(log: DataFrame, by: str, event: str, order: list[str]) -> DataFrame:
    """A status log folded: attempts count starts, the last event is the status."""
    o = F.struct(*order)
    return log.groupBy(by).agg(F.count_if(F.col(event) == "running").alias("attempt_count"), F.max_by(event, o).alias("status"), F.count(F.lit(1)).alias("n_events"))


def gate(records: DataFrame, fingerprint: str, required: list[str], now: Column, max_age_hours: int) -> DataFrame:
    """The first reason, in fixed order, why a gate record doesn't let a release pass; null: it does."""
    at = F.try_to_timestamp(F.col("attested_at"))
    why = (
        F.when(F.col("status").isNull(), "absent")
        .when(F.col("status") != "passed", "not passed")
        .when(~F.col("fingerprint").eqNullSafe(F.lit(fingerprint)), "fingerprint differs")
        .when(at.isNull(), "bad timestamp")
        .when(at + F.make_interval(hours=F.lit(max_age_hours)) < now, "older than allowed")
        .when(F.size(F.array_except(F.array(*map(F.lit, required)), F.col("checks"))) > 0, "checks missing")
    )
    return records.withColumn("failure", why).withColumn("passed", F.col("failure").isNull())


def gate_record(pipeline: str, environment: str, scope: str, status: str, workload: str, checks: list[str], attested_at: str, details: dict | None = None) -> dict:
    """What a rehearsal leaves behind for `gate` to judge; written to the control table as the payload of its scope."""
    return {"pipeline": pipeline, "environment": environment, "scope": scope, "status": status, "fingerprint": workload, "checks": sorted(set(checks)), "attested_at": attested_at, "details": details or {}}


def enforce(records: DataFrame, *, environment: str, required: bool, pipeline: str, scope: str, workload: str, checks: list[str], now: Column, max_age_hours: int) -> None:
    """Raise unless the scope's rehearsal lets a production run pass. records: pipeline, scope and the columns of `gate`; other environments and runs that require none pass."""
    if environment != "prod" or not required:
        return
    if not scope:
        raise ValueError("a required gate needs a scope")
    found = records.where((F.col("pipeline") == pipeline) & (F.col("scope") == scope))
    first = gate(found, workload, checks, now, max_age_hours).orderBy(F.desc("attested_at")).select("failure").first()
    if first is None or first.failure:
        raise PermissionError(f"release gate of {pipeline}, {scope}: {first.failure if first else 'absent'}")


def scope_fingerprint(**query: object) -> str:
    """What a resume position belongs to: the job, its query, order, shard and bounds. Another scope starts over."""
    return fingerprint({k: v for k, v in query.items() if v is not None})


def workload_fingerprint(pipeline: str, pieces: list[dict], settings: dict) -> str:
    """The logical workload: what is moved and how, not where credentials, files or logs are."""
    local = {"connection", "key", "password", "worker", "run_id", "log", "metrics", "dead_letters"}
    return fingerprint({"pipeline": pipeline, "pieces": [{k: v for k, v in p.items() if k not in local} for p in pieces], "settings": {k: v for k, v in settings.items() if k not in local}})


def fingerprint(workload: dict) -> str:
    """sha256 of the workload's JSON with sorted keys."""
    return hashlib.sha256(json.dumps(workload, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def schema_diff(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """Columns (table_name, column_name) that mappings want and tables lack; more columns in a table are fine."""
    return wanted.join(have, ["table_name", "column_name"], "left_anti")


def retry_delay(attempt: Column, first: float, most: float, factor: float) -> Column:
    """Delay before the next attempt, without jitter."""
    return F.least(F.lit(most), F.lit(first) * F.pow(F.lit(factor), attempt - 1))
