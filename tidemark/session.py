"""Session settings the engine counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def session(app: str = "tidemark", master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | more)
    return (builder.master(master) if master else builder).getOrCreate()
