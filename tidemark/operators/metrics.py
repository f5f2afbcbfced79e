"""Metric series: counters, gauges and observations rolled up, and their text and JSON snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Samples: at orders the values of a gauge.
SAMPLES = "name string, kind string, labels map<string,string>, value double, at long, description string"


def _clean(name: Column, allowed: str, prefix: str) -> Column:
    clean = F.regexp_replace(F.trim(name), f"[^{allowed}]", "_")
    return F.when(clean.rlike("^[0-9]"), F.concat(F.lit(prefix), clean)).otherwise(clean)


def metric_name(name: Column) -> Column:
    """Only letters, digits, _ and :; no digit first."""
    return _clean(name, "a-zA-Z0-9_:", "metric_")


def label_name(name: Column) -> Column:
    """Only letters, digits and _; no digit first."""
    return _clean(name, "a-zA-Z0-9_", "label_")


def label_value(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))


def sorted_labels(labels: Column, static: dict[str, str] | None = None) -> Column:
    """Label pairs (key, value) by name, names cleaned; blank values are left out, a sample's own win over static ones."""
    own = F.filter(F.map_entries(F.coalesce(labels, F.create_map().cast("map<string,string>"))), lambda e: e["value"].isNotNull() & (e["value"] != ""))
    own = F.transform(own, lambda e: F.struct(label_name(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.transform(own, lambda e: e["key"])
    more = [F.filter(F.array(F.struct(F.lit(k).alias("key"), F.lit(v).alias("value"))), lambda e: ~F.array_contains(names, e["key"])) for k, v in (static or {}).items()]
    return F.array_sort(F.concat(own, *more)) if more else F.array_sort(own)


def rendered(labels: Column) -> Column:
    """{name="value",...} of label pairs, nothing where there are none."""
    pairs = F.transform(labels, lambda e: F.concat(e["key"], F.lit('="'), label_value(e["value"]), F.lit('"')))
    return F.when(F.size(labels) == 0, "").otherwise(F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")))


def collected(samples: DataFrame, static: dict[str, str] | None = None) -> DataFrame:
    """Series of samples (see SAMPLES): name, type, description, labels (sorted pairs), value.

    A counter is the sum of its samples, a gauge the last one; an observation makes a count and a sum (counters) and a
    maximum (a gauge) under names of their own. A description is the first in order that its name has.
    """
    rows = samples.select(metric_name(F.col("name")).alias("name"), "kind", sorted_labels(F.col("labels"), static).alias("labels"), "value", "at", F.nullif(F.trim(F.coalesce("description", F.lit(""))), F.lit("")).alias("description"))
    seen = F.col("kind") == "observe"
    each = F.when(seen, F.array(*[F.struct(F.concat("name", F.lit(f"_{n}")).alias("name"), F.lit(t).alias("type"), F.lit(f).alias("fold"), v.alias("value"), F.concat(F.lit(f"{d} for "), F.coalesce("description", "name"), F.lit(".")).alias("description")) for n, t, f, v, d in (("count", "counter", "sum", F.lit(1.0), "Observation count"), ("sum", "counter", "sum", F.col("value"), "Observation sum"), ("max", "gauge", "max", F.col("value"), "Maximum observed value"))])).otherwise(
        F.array(F.struct("name", F.col("kind").alias("type"), F.when(F.col("kind") == "counter", "sum").otherwise("last").alias("fold"), F.col("value"), F.coalesce("description", "name").alias("description")))
    )
    flat = rows.select("labels", "at", F.explode(each).alias("s")).select("labels", "at", "s.*")
    value = F.when(F.max("fold") == "sum", F.sum("value")).when(F.max("fold") == "max", F.max("value")).otherwise(F.max_by("value", F.struct("at", "value")))
    return flat.groupBy("name", "type", "labels").agg(F.min("description").alias("description"), value.alias("value"))


def clashing(samples: DataFrame) -> DataFrame:
    """Names that samples use as several types."""
    return samples.groupBy(metric_name(F.col("name")).alias("name")).agg(F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"), F.count_distinct("kind").alias("n")).where("n > 1")


def text_lines(series: DataFrame) -> DataFrame:
    """name, part, line: HELP and TYPE once for each name, then its samples; in order of (name, part, line)."""
    heads = series.groupBy("name").agg(F.min("description").alias("description"), F.min("type").alias("type"))
    help_ = heads.select("name", F.lit(0).alias("part"), F.concat(F.lit("# HELP "), "name", F.lit(" "), "description").alias("line"))
    type_ = heads.select("name", F.lit(1).alias("part"), F.concat(F.lit("# TYPE "), "name", F.lit(" "), "type").alias("line"))
    return help_.unionByName(type_).unionByName(series.select("name", F.lit(2).alias("part"), F.concat("name", rendered(F.col("labels")), F.lit(" "), F.col("value").cast("string")).alias("line")))


def json_lines(series: DataFrame) -> DataFrame:
    """name, line: one JSON object for each series, keys sorted."""
    labels = F.map_from_entries(F.transform("labels", lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))))
    return series.select("name", F.to_json(F.struct("description", labels.alias("labels"), "name", "type", "value")).alias("line"))


def write_snapshot(series: DataFrame, path: str, form: str = "text") -> None:
    """One file of a snapshot; series are few, whatever the data they tell of."""
    if form not in ("text", "json"):
        raise ValueError("a snapshot is text or json")
    lines = text_lines(series).orderBy("name", "part", "line") if form == "text" else json_lines(series).orderBy("name", "line")
    lines.select("line").coalesce(1).write.mode("overwrite").text(path)


def rollup(samples: DataFrame, by: list[str], value: str) -> DataFrame:
    """count, sum and max of observations per series."""
    return samples.groupBy(*by).agg(F.count(value).alias("obs_count"), F.sum(value).alias("obs_sum"), F.max(value).alias("obs_max"))
