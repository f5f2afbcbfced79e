"""Size routing of records to one of two sinks and the replay-safe registry of where each record is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOCUMENT, RELATIONAL, REJECT = "document", "relational", "reject"
REGISTRY = "route_key string, destination string, checksum string, size long, updated_at string, sync_state string, cleanup_from string"


def destination(size: Column, lower: int, upper: int, overhead: int = 0) -> Column:
    """Below lower the document sink, up to upper the relational one, else rejected; size counts with the overhead."""
    full = size + F.lit(overhead)
    return F.when(full < lower, DOCUMENT).when(full <= upper, RELATIONAL).otherwise(REJECT)


def reason(size: Column, lower: int, upper: int, overhead: int = 0) -> Column:
    full = (size + F.lit(overhead)).cast("string")
    d = destination(size, lower, upper, overhead)
    return F.when(d == DOCUMENT, F.concat(full, F.lit(f" bytes < {lower}"))).when(d == RELATIONAL, F.concat(full, F.lit(f" bytes in [{lower}, {upper}]"))).otherwise(F.concat(full, F.lit(f" bytes > {upper}")))


def actions(records: DataFrame, registry: DataFrame) -> DataFrame:
    """records: route_key, destination, checksum, size. registry: route_key and the columns below.

    action: reject; finalize (unchanged, an old copy still to be deleted); skip (unchanged); insert; update; move.
    """
    r = registry.select("route_key", F.col("destination").alias("old_destination"), F.col("checksum").alias("old_checksum"), F.col("sync_state").alias("old_state"), F.col("cleanup_from").alias("old_cleanup"))
    met = records.join(r, "route_key", "left")
    same = (F.col("old_destination") == F.col("destination")) & (F.col("old_checksum") == F.col("checksum"))
    action = (
        F.when(F.col("destination") == REJECT, "reject")
        .when(same & (F.col("old_state") == "pending_cleanup"), "finalize")
        .when(same, "skip")
        .when(F.col("old_destination").isNull(), "insert")
        .when(F.col("old_destination") == F.col("destination"), "update")
        .otherwise("move")
    )
    return met.withColumn("action", action)


def next_registry(acted: DataFrame, registry: DataFrame, cleanup_failed: Column, now: Column) -> DataFrame:
    """The registry after the run. Moves whose old copy couldn't be deleted stay pending_cleanup; rejected records keep their entry."""
    changed = acted.where("action not in ('reject', 'skip')").select(
        "route_key", "destination", "checksum", "size", now.alias("updated_at"),
        F.when(F.col("action").isin("move", "finalize") & cleanup_failed, "pending_cleanup").otherwise("complete").alias("sync_state"),
        F.when(F.col("action").isin("move", "finalize") & cleanup_failed, F.when(F.col("action") == "move", F.col("old_destination")).otherwise(F.col("old_cleanup"))).alias("cleanup_from"),
    )
    return registry.join(changed.select("route_key"), "route_key", "left_anti").unionByName(changed)


def writes(acted: DataFrame) -> dict[str, DataFrame]:
    """The run's writes in the order that keeps it replay-safe: upserts, then deletes of old copies."""
    up = acted.where("action in ('insert', 'update', 'move')")
    old = acted.where("action = 'move'").select("route_key", F.col("old_destination").alias("sink")).unionByName(acted.where("action = 'finalize' and old_cleanup is not null").select("route_key", F.col("old_cleanup").alias("sink")))
    return {"upsert": up, "delete": old}


def statistics(acted: DataFrame, by: list[str], ok: Column | None = None, cleaned: Column | None = None, late: Column | None = None, seen: Column | None = None) -> DataFrame:
    """Disposition counters. ok: the write succeeded; cleaned: the old copy's delete did; late: out of order; seen: in the checkpoint already."""
    names = ["reject", "finalize", "skip", "insert", "update", "move"]
    true, false = F.lit(True), F.lit(False)
    ok, cleaned, late, seen = (true if ok is None else ok), (true if cleaned is None else cleaned), (false if late is None else late), (false if seen is None else seen)
    live, action = ~seen, F.col("action")
    writes = live & ok & action.isin("insert", "update", "move")
    return acted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"),
        *[F.count_if(live & (action == n)).alias(f"n_{n}") for n in names],
        F.count_if(writes & (F.col("destination") == DOCUMENT)).alias("document_writes"),
        F.count_if(writes & (F.col("destination") == RELATIONAL)).alias("relational_writes"),
        F.count_if(seen).alias("checkpoint_skipped"),
        F.count_if(live & late).alias("out_of_order"),
        F.count_if(live & ~ok & (action != "reject")).alias("failed"),
        F.count_if(live & ok & ~cleaned & action.isin("move", "finalize")).alias("cleanup_failed"),
    )


def owners(keys: DataFrame, namespaces: DataFrame) -> DataFrame:
    """keys: route_key; namespaces: namespace, job. The job of the longest namespace that is the key or a prefix of it up to a |.

    An equi-join: the key's own prefixes at each | are exploded, so no row meets every namespace.
    """
    parts = F.split("route_key", "\\|")
    prefix = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "|"))
    met = keys.select("route_key", F.explode(prefix).alias("namespace")).join(namespaces, "namespace")
    best = met.groupBy("route_key").agg(F.max_by("job", F.length("namespace")).alias("job"))
    return keys.join(best, "route_key", "left")
