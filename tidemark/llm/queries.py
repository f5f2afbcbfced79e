"""The queries of the training-data operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_codec, html_text, impact_search, jaccard_join, language, licenses, line_dedup, oracles, packing, quality, records
from tidemark.llm.common import gathered, staged, table


def op1_html(spark: SparkSession, d: str) -> DataFrame:
    return html_text.extract(table(spark, d, "pages"))


def op2_records(spark: SparkSession, d: str) -> DataFrame:
    return records.records(table(spark, d, "documents"))


def op3_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_join.join(table(spark, d, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_language(spark: SparkSession, d: str) -> DataFrame:
    return language.identify(table(spark, d, "documents"))


def op5_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(table(spark, d, "documents"))


def op6_lines(spark: SparkSession, d: str) -> DataFrame:
    out = line_dedup.dedup(table(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("clean_text").alias("text"), "n_units", "n_removed", F.to_json("removed_spans").alias("removed_spans"))


def op7_search(spark: SparkSession, d: str) -> DataFrame:
    return impact_search.search(table(spark, d, "embeddings"))


def op8_codec(spark: SparkSession, d: str) -> DataFrame:
    return bpe_codec.digests(table(spark, d, "documents"))


def op9_licenses(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan(table(spark, d, "documents")).drop("spans")


def op10_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    measures = staged(gathered(quality.measured(docs).drop("text"), docs), "quality-measures")
    cutoffs = staged(gathered(quality.calibrate(measures, table(spark, d, "labels")), measures), "quality-cutoffs")
    return quality.judged(measures, cutoffs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline  # at the repository's top, beside the entry

    return corpus_pipeline.run(spark, d)


def queries() -> dict:
    return {f.__name__: f for f in (op1_html, op2_records, op3_jaccard, op4_language, op5_packing, op6_lines, op7_search, op8_codec, op9_licenses, op10_quality, pipeline)}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
