"""Structured Streaming forms of the incremental load and of the routing registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import mapping, routing
from tidemark.sources.store import Versions


def upserts(batch: DataFrame, keys: list[str], order: list[str], deleted: str) -> tuple[DataFrame, DataFrame]:
    """Rows to write and keys to delete: the last change of each key decides."""
    last = mapping.latest(batch, keys, *order)
    return last.where(f"not {deleted}"), last.where(deleted).select(*keys)


def apply_changes(target: DataFrame | None, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows after a batch. Changes older than what the table holds of a key don't win, so late batches and replays do no harm."""
    return mapping.latest(batch if target is None else batch.unionByName(target), keys, *order)


def drained(source: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]) -> None:
    """Everything the stream has now, batch by batch."""
    source.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_changes(source: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str], deleted: str, *, buckets: int = 64) -> DataFrame:
    """Drain a stream of changes into a versioned table (tombstones kept in it); gives its live rows. A batch rewrites the buckets of its keys only."""
    store = Versions(source.sparkSession, path)

    def step(batch: DataFrame, number: int) -> None:
        last = mapping.latest(batch, keys, *order).persist()
        store.merge(last, keys, lambda old, new: apply_changes(old, new, keys, order), buckets=buckets)
        last.unpersist()

    drained(source, checkpoint, step)
    rows = store.read()
    return (source.sparkSession.createDataFrame([], source.schema) if rows is None else rows).where(f"not {deleted}")


def run_routing(records: DataFrame, path: str, checkpoint: str, order: list[str], now: Column, cleanup_failed: Column | None = None, *, buckets: int = 64) -> DataFrame | None:
    """The routing state machine over a stream: each batch's last record of a key meets the registry's buckets of its keys."""
    store = Versions(records.sparkSession, path)

    def step(batch: DataFrame, number: int) -> None:
        last = mapping.latest(batch, ["route_key"], *order).persist()

        def routed(old: DataFrame | None, new: DataFrame) -> DataFrame:
            registry = records.sparkSession.createDataFrame([], routing.REGISTRY) if old is None else old
            return routing.next_registry(routing.actions(new, registry), registry, F.lit(False) if cleanup_failed is None else cleanup_failed, now)

        store.merge(last, ["route_key"], routed, buckets=buckets)
        last.unpersist()

    drained(records, checkpoint, step)
    return store.read()


def file_changes(spark: SparkSession, folder: str, schema, name: str) -> DataFrame:
    """A table's files as a stream, whether it is one file or a folder of parts."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return spark.readStream.schema(schema).parquet(f"{folder}/{name}")
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
