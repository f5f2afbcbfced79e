"""Canonical records: one envelope for documents and for typed rows, whatever source they come from.

An envelope has source_job, source_api, source_namespace, source_key, route_key, payload (canonical JSON text),
payload_size_bytes, checksum, event_ts and watermark; error says why a row has none of these (null: it has).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DateType, DecimalType, MapType, StructType, TimestampNTZType, TimestampType

from tidemark.functions.convert import CONVERTERS, at_path
from tidemark.functions.text import canonical_json, checksum, iso_utc, json_bytes, route_key, source_key

ENVELOPE = ["source_job", "source_api", "source_namespace", "source_key", "route_key", "payload", "payload_size_bytes", "checksum", "event_ts", "watermark"]


def jsonable(c: Column, kind: DataType) -> Column:
    """A value of any nesting as JSON can hold it: times as UTC ISO text, dates and decimals as text, bytes as base64 under a marker."""
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return iso_utc(c)
    if isinstance(kind, (DateType, DecimalType)):
        return c.cast("string")
    if isinstance(kind, BinaryType):
        return F.when(c.isNotNull(), F.struct(F.base64(c).alias("__base64__")))
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: jsonable(x, kind.elementType))
    if isinstance(kind, MapType):
        return F.map_from_entries(F.transform(F.map_entries(c), lambda e: F.struct(e["key"].cast("string").alias("key"), jsonable(e["value"], kind.valueType).alias("value"))))
    if isinstance(kind, StructType):
        return F.when(c.isNotNull(), F.struct(*[jsonable(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return c


def row_payload(rows: DataFrame, columns: list[str] | None = None) -> Column:
    """The columns of a typed row as one JSON text, nulls kept."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    return F.to_json(F.struct(*[jsonable(F.col(f"`{n}`"), kinds[n]).alias(n) for n in columns or rows.columns]), {"ignoreNullFields": "false"})


def canonical(rows: DataFrame, raw: str, *, job: str, api: str, namespace: str, keys: list[str], watermark: str | None = None) -> DataFrame:
    """The rows' columns, their envelopes from the JSON text in `raw`, and error.

    A record that isn't an object or lacks a key field is an error. Without a watermark field, or where a record lacks
    it, watermark and event_ts are null: the time of reading isn't the source's and would differ in every comparison.
    """
    doc = F.col("_doc")
    found = rows.withColumn("_doc", F.try_parse_json(raw))
    parts = [F.when(F.is_variant_null(at_path(doc, k)), F.lit("None")).otherwise(CONVERTERS["string"](at_path(doc, k))) for k in keys]
    error = F.coalesce(F.when(doc.isNull() | ~F.startswith(F.schema_of_variant(doc), F.lit("OBJECT")), F.lit("not a JSON object")), *[F.when(at_path(doc, k).isNull(), F.lit(f"no key field {k}")) for k in keys])
    mark = CONVERTERS["string"](at_path(doc, watermark)) if watermark else F.lit(None).cast("string")
    found = found.withColumns({"_error": error, "_key": source_key(*parts), "payload": canonical_json(F.col(raw)), "watermark": mark})
    good = F.col("_error").isNull()
    made = {
        "source_job": F.lit(job),
        "source_api": F.lit(api),
        "source_namespace": F.lit(namespace),
        "source_key": F.when(good, F.col("_key")),
        "route_key": F.when(good, route_key(F.lit(namespace), F.col("_key"))),
        "payload": F.when(good, F.col("payload")),
        "payload_size_bytes": F.when(good, json_bytes(F.col("payload"))),
        "checksum": F.when(good, checksum(F.col("payload"))),
        "event_ts": F.col("watermark"),
        "watermark": F.col("watermark"),
    }
    kept = [c for c in rows.columns if c not in (*ENVELOPE, "error")]
    return found.select(*kept, *[v.alias(k) for k, v in made.items()], F.col("_error").alias("error"))


def canonical_rows(rows: DataFrame, *, job: str, api: str, namespace: str, keys: list[str], watermark: str | None = None) -> DataFrame:
    """Envelopes of typed rows (tables rather than documents)."""
    return canonical(rows.select(row_payload(rows).alias("_raw")), "_raw", job=job, api=api, namespace=namespace, keys=keys, watermark=watermark).drop("_raw")


def ambiguous(records: DataFrame) -> DataFrame:
    """Route keys that records of different payloads share: parts of a composite key that hold the separator can collide."""
    return records.groupBy("route_key").agg(F.count_distinct("checksum").alias("n_payloads")).where("n_payloads > 1")
