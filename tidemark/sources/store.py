"""Reading and writing tables: versioned tables, state scans, dead letters and catalog checks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, path: str, *, limit: int | None = None, order: str | None = None) -> DataFrame:
    """JSON lines as raw text and VARIANT; what isn't JSON has a null doc. A limit needs an order to be repeatable."""
    df = spark.read.text(path).select(F.col("value").alias("raw"), F.try_parse_json("value").alias("doc"))
    return (df.orderBy(order) if order else df).limit(limit) if limit else df


def query(spark: SparkSession, sql: str, **args) -> DataFrame:
    """A query with named parameters, bound rather than pasted in."""
    return spark.sql(sql, args=args)


def templated(sql: str, shard: int, shards: int) -> str:
    """A query template with the shard's number and the count of shards put in."""
    return sql.replace("{{SHARD_INDEX}}", str(shard)).replace("{{SHARD_COUNT}}", str(shards))


def incremental_query(spark: SparkSession, name: str, field: str | None = None, watermark: object = None, sql: str | None = None) -> DataFrame:
    """All of a table, or from the watermark on. A query of one's own must hold :watermark then, else the bound would be lost."""
    if field is None or watermark is None:
        return spark.sql(sql, args={"watermark": None} if ":watermark" in sql else None) if sql else spark.table(name)
    if sql and ":watermark" not in sql:
        raise ValueError("an incremental query needs :watermark")
    return query(spark, sql, watermark=watermark) if sql else spark.table(name).where(F.col(field) >= F.lit(watermark))


def sort_spec(keys: list[str], field: str | None = None, tie: str | None = None) -> list[str]:
    """The incremental field, the keys and the tie breaker, each once."""
    return list(dict.fromkeys([c for c in (field, *keys, tie) if c]))


def read_columns(keys: list[str], columns: list[str]) -> list[str]:
    """Keys, then the other columns, each once."""
    return list(dict.fromkeys([*keys, *columns]))


def ordered_rows(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A table's keys and columns in key order, for readers that stream it."""
    return df.select(*read_columns(keys, columns)).orderBy(*keys)


def probe(df: DataFrame) -> bool:
    """Whether the source can be read and has a row."""
    return not df.limit(1).isEmpty()


def numbered_batches(df: DataFrame, order: str, size: int, *, buckets: int = 64) -> DataFrame:
    """batch: the number of the write batch of `size` rows that a row falls in, by the integer column `order`. Ranges of it are numbered apart, so no window holds the whole table."""
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    step = max(1, ((hi or 0) - (lo or 0)) // buckets + 1)
    rows = df.withColumn("_range", F.floor((F.col(order) - F.lit(lo or 0)) / F.lit(step)))
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")  # a row a range
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return rows.join(F.broadcast(before), "_range").withColumn("batch", F.floor(place / F.lit(size))).drop("_range", "_before")


def bounded(df: DataFrame, conditions: dict[str, object], field: str | None = None, lower: object = None) -> DataFrame:
    """Equality conditions and an inclusive lower bound, which replaces a condition on its own field. All reach the scan."""
    for name, v in conditions.items():
        if not (lower is not None and name == field):
            df = df.where(F.col(name).isNull() if v is None else F.col(name) == F.lit(v))
    return df.where(F.col(field) >= F.lit(lower)) if lower is not None else df


def by_keys(df: DataFrame, keys: DataFrame, on: list[str], *, broadcast_rows: int = 100_000) -> DataFrame:
    """Rows with one of the keys; few keys (counted) are broadcast, more are joined by shuffle."""
    few = keys.limit(broadcast_rows + 1).count() <= broadcast_rows
    return df.join(F.broadcast(keys) if few else keys, on, "left_semi")


def state(df: DataFrame, namespace: str, prefix: str | None = None) -> DataFrame:
    """Control rows of a namespace (a partition, so others aren't read), by key; those with the prefix only if given."""
    rows = df.where(F.col("namespace") == namespace)
    return (rows.where(F.col("record_key").startswith(prefix)) if prefix else rows).orderBy("record_key")


def state_of(df: DataFrame, namespace: str, keys: list[str]) -> DataFrame:
    """Control rows of some keys (a few, named by the caller); keys that aren't there have no row."""
    return df.where((F.col("namespace") == namespace) & F.col("record_key").isin(keys))


def json_state(spark: SparkSession, path: str) -> dict:
    """A whole JSON file as a state: empty where there is none, an error where it can't be read as an object."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return {}
    text = spark.read.text(path, wholetext=True).first()
    try:
        found = json.loads(text[0] if text else "")
    except ValueError as e:
        raise ValueError(f"{path} is corrupt") from e
    if not isinstance(found, dict):
        raise ValueError(f"{path} isn't a state")
    return found


def missing_columns(spark: SparkSession, name: str, wanted: list[str]) -> list[str]:
    """Columns wanted that the catalog's table lacks; all of them if there is no table."""
    have = {c.name for c in spark.catalog.listColumns(name)} if spark.catalog.tableExists(name) else set()
    return [c for c in dict.fromkeys(wanted) if c not in have]


class Versions:
    """A table as written versions and numbered pointer files, the highest of which names the present one. One driver writes.

    Nothing is renamed or deleted before a newer pointer stands whole, so a crash between any two steps leaves the old
    version or the new one. A pointer that a crash left empty doesn't count. The last `keep` versions stay for readers.
    """

    def __init__(self, spark: SparkSession, path: str, *, keep: int = 3) -> None:
        self.spark, self.path, self.keep = spark, path, keep
        self.fs = self._p("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _p(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _pointers(self) -> list[int]:
        """Numbers of the pointers, highest first."""
        if not self.fs.exists(self._p("_pointers")):
            return []
        names = [(f.getPath().getName(), f.getLen()) for f in self.fs.listStatus(self._p("_pointers"))]
        return sorted((int(n) for n, size in names if n.isdigit() and size), reverse=True)

    def _pointer(self, number: int) -> dict:
        stream = self.fs.open(self._p(f"_pointers/{number:012d}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return {"parts": None, **json.loads(text), "number": number}
        except (ValueError, TypeError) as e:
            raise ValueError(f"{self.path}/_pointers/{number:012d} is corrupt") from e

    def current(self) -> dict | None:
        """The highest pointer: version, and the version of each bucket where the table has buckets."""
        numbers = self._pointers()
        return self._pointer(numbers[0]) if numbers else None

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The table, or some of its buckets."""
        found = self.current()
        if not found:
            return None
        if found["parts"] is None:
            return self.spark.read.schema(found["schema"]).parquet(f"{self.path}/{found['version']}")
        paths = [f"{self.path}/{v}/_bucket={b}" for b, v in found["parts"].items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(found["schema"]).parquet(*paths) if paths else self.spark.createDataFrame([], found["schema"])

    def publish(self, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Write a whole new version, then its pointer."""
        v = f"v-{uuid.uuid4().hex}"
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(f"{self.path}/{v}")
        return self._point({"version": v, "schema": df._jdf.schema().toDDL()})

    def merge(self, changes: DataFrame, keys: list[str], apply: Callable[[DataFrame | None, DataFrame], DataFrame], *, buckets: int = 64) -> str | None:
        """Rewrite the buckets (by hash of the keys) that changes touch: apply(their rows or None, changes). The others stay as they are."""
        found = self.current()
        parts = dict((found or {}).get("parts") or {})
        buckets = (found or {}).get("buckets") or buckets
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        touched = [r[0] for r in changes.select(bucket.alias("b")).distinct().collect()]  # at most `buckets` rows
        if not touched:
            return None
        old = self.read(touched) if set(map(str, touched)) & set(parts) else None
        rows = apply(old, changes)
        v = f"v-{uuid.uuid4().hex}"
        rows.withColumn("_bucket", bucket).repartition(len(touched), "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{v}")
        have = {f.getPath().getName() for f in self.fs.listStatus(self._p(v))}
        for b in touched:
            parts.pop(str(b), None)
            if f"_bucket={b}" in have:
                parts[str(b)] = v
        return self._point({"version": v, "schema": rows._jdf.schema().toDDL(), "parts": parts, "buckets": buckets})

    def _point(self, what: dict) -> str:
        number = ((self._pointers() or [0])[0]) + 1
        if self.fs.exists(self._p(f"_pointers/{number:012d}")):  # what a crash left empty
            self.fs.delete(self._p(f"_pointers/{number:012d}"), False)
        out = self.fs.create(self._p(f"_pointers/{number:012d}"), False)
        out.write(bytearray(json.dumps(what).encode()))
        out.close()
        self._clear()
        return what["version"]

    def _clear(self) -> None:
        """Versions that none of the last `keep` pointers names go, then older pointers."""
        numbers = self._pointers()
        used = {v for n in numbers[: self.keep] for p in [self._pointer(n)] for v in (p["version"], *(p["parts"] or {}).values())}
        for n in numbers[self.keep :]:
            for v in {(p := self._pointer(n))["version"], *(p["parts"] or {}).values()} - used:
                self.fs.delete(self._p(v), True)
            self.fs.delete(self._p(f"_pointers/{n:012d}"), False)


def append_dead_letters(letters: DataFrame, path: str) -> None:
    letters.write.mode("append").json(path)


def dry_run(df: DataFrame) -> None:
    """Run the whole plan and write nothing."""
    df.write.format("noop").mode("overwrite").save()
