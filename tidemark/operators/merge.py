"""Keyed writes as rewrites of a table: a table format with MERGE isn't needed.

Keys must be unique and not null in either side; `checked` parts what may be written from what may not. Columns that the
target lacks are an error, not lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def checked(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that can be written, the others with `reason`): rows with a null key, and all rows of a key that several have."""
    no_key = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    counted = rows.withColumns({"_n": F.count(F.lit(1)).over(Window.partitionBy(*keys)), "_null": no_key})
    bad = counted.where("_null or _n > 1").withColumn("reason", F.when(F.col("_null"), "key is null").otherwise("key is repeated"))
    return counted.where("not _null and _n = 1").drop("_n", "_null"), bad.drop("_n", "_null")


def _known(target: DataFrame, rows: DataFrame, keys: list[str]) -> None:
    if more := [c for c in rows.columns if c not in target.columns]:
        raise ValueError(f"the target has no columns {more}")
    if lost := [k for k in keys if k not in rows.columns]:
        raise ValueError(f"the rows have no key columns {lost}")


def insert(target: DataFrame, rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(the new table, rejected rows whose key exists)."""
    _known(target, rows, keys)
    fresh = rows.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True), rows.join(target.select(*keys), keys, "left_semi")


def _overlay(target: DataFrame, rows: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Columns of rows win where a key is in rows, even with nulls; other columns stay."""
    _known(target, rows, keys)
    listed = [c for c in rows.columns if c not in keys]
    side = rows.select(*keys, F.struct(*listed).alias("_new"))
    out = target.join(side, keys, how)
    return out.select(*[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in listed else F.col(c) for c in target.columns])


def update(target: DataFrame, rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(the new table, rejected rows whose key doesn't exist)."""
    return _overlay(target, rows, keys, "left"), rows.join(target.select(*keys), keys, "left_anti")


def upsert(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    return _overlay(target, rows, keys, "full_outer")


def replace(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Whole rows are replaced: columns that rows don't list become null."""
    _known(target, rows, keys)
    return target.join(rows.select(*keys), keys, "left_anti").unionByName(rows, allowMissingColumns=True).select(*target.columns)


def delete(target: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(gone.select(*keys), keys, "left_anti")
