"""The two sinks of routed records as versioned tables, their read-back, and the adapter protocols.

A sink keeps what was stored with a record (checksum and size); reading it back works both out again from the payload,
so that a copy that was changed or cut short shows. Writes are merges keyed by route key, so a replay changes nothing.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import canonical_json, checksum, json_bytes
from tidemark.operators import merge
from tidemark.sources.store import Versions, dry_run

#: Field of the envelope -> column of the sink.
DOCUMENT = {"source_job": "sourceJob", "source_api": "sourceApi", "source_namespace": "sourceNamespace", "source_key": "sourceKey", "route_key": "routeKey", "payload": "payload", "payload_size_bytes": "payloadSizeBytes", "checksum": "checksum", "event_ts": "eventTs"}
RELATIONAL = {k: v[0].upper() + v[1:] for k, v in DOCUMENT.items()} | {"payload": "PayloadJson"}


class SourceAdapter(Protocol):
    def records(self, spark: SparkSession) -> DataFrame:
        """Envelopes, see operators.records."""


class SinkReader(Protocol):
    def read(self) -> DataFrame:
        """Envelopes as read back, with destination, stored_checksum, stored_size and stale."""


class SinkAdapter(SinkReader, Protocol):
    def upsert(self, records: DataFrame) -> None: ...

    def delete(self, keys: DataFrame) -> None: ...


class TableSource:
    """A source adapter over any table: rows are made into envelopes."""

    def __init__(self, path: str, *, job: str, api: str, namespace: str, keys: list[str], watermark: str | None = None) -> None:
        self.path, self.how = path, {"job": job, "api": api, "namespace": namespace, "keys": keys, "watermark": watermark}

    def records(self, spark: SparkSession) -> DataFrame:
        from tidemark.operators.records import canonical_rows

        return canonical_rows(spark.read.parquet(self.path), **self.how)


class Sink:
    """names: the sink's column of each envelope field. id_of: a column that identifies a record, made from its route key."""

    def __init__(self, spark: SparkSession, path: str, destination: str, names: dict[str, str], *, id_column: str | None = None, updated: str | None = None, dry: bool = False, buckets: int = 64) -> None:
        self.spark, self.table, self.destination, self.names = spark, Versions(spark, path), destination, names
        self.id_column, self.updated, self.dry, self.buckets = id_column, updated, dry, buckets

    @property
    def key(self) -> str:
        return self.id_column or self.names["route_key"]

    def id_of(self, route_key: Column) -> Column:
        return F.sha2(route_key, 256) if self.id_column else route_key

    def rows(self, records: DataFrame, now: Column | None = None) -> DataFrame:
        """Records as the sink's rows; the time of the write is the sink's own."""
        own = [self.id_of(F.col("route_key")).alias(self.id_column)] if self.id_column else []
        time = [(F.current_timestamp() if now is None else now).alias(self.updated)] if self.updated else []
        return records.select(*own, *[F.col(a).alias(b) for a, b in self.names.items()], *time)

    def upsert(self, records: DataFrame, now: Column | None = None) -> None:
        """Rewrites the table's buckets that the records fall in."""
        rows = self.rows(records, now)
        if self.dry:
            dry_run(rows)
        else:
            self.table.merge(rows, [self.key], lambda old, new: new if old is None else merge.upsert(old, new, [self.key]), buckets=self.buckets)

    def delete(self, keys: DataFrame) -> None:
        """keys: route_key."""
        if not self.dry and self.table.current():
            gone = keys.select(self.id_of(F.col("route_key")).alias(self.key))
            self.table.merge(gone, [self.key], lambda old, new: self.table.read().limit(0) if old is None else merge.delete(old, new, [self.key]))

    def read(self) -> DataFrame | None:
        """Envelopes with size and checksum worked out again; stale: what was stored with the record differs from that."""
        rows = self.table.read()
        return None if rows is None else read_back(rows, self.names, self.destination)


def read_back(rows: DataFrame, names: dict[str, str], destination: str) -> DataFrame:
    payload = canonical_json(F.col(names["payload"]))
    fields = [F.col(names[n]).alias(n) for n in ("source_job", "source_api", "source_namespace", "source_key", "route_key", "event_ts")]
    out = rows.select(F.lit(destination).alias("destination"), *fields, payload.alias("payload"), F.col(names["checksum"]).alias("stored_checksum"), F.col(names["payload_size_bytes"]).alias("stored_size"))
    out = out.withColumns({"checksum": checksum(F.col("payload")), "payload_size_bytes": json_bytes(F.col("payload"))})
    # A stored size that is missing isn't held against a record; a payload that isn't JSON is.
    return out.withColumn("stale", ~F.col("stored_checksum").eqNullSafe(F.col("checksum")) | (F.coalesce("stored_size", "payload_size_bytes") != F.col("payload_size_bytes")) | F.col("payload").isNull())


def document_sink(spark: SparkSession, path: str, **more) -> Sink:
    """Keyed by the sha256 of the route key."""
    return Sink(spark, path, "document", DOCUMENT, id_column="docId", **more)


def relational_sink(spark: SparkSession, path: str, **more) -> Sink:
    """Ten columns, keyed by the route key."""
    return Sink(spark, path, "relational", RELATIONAL, updated="UpdatedAt", **more)


def all_records(*sinks: SinkReader) -> DataFrame | None:
    """What the sinks hold together; None where none was written to."""
    found = [r for s in sinks if (r := s.read()) is not None]
    out = found[0] if found else None
    for r in found[1:]:
        out = out.unionByName(r)
    return out
