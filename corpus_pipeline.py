"""Corpus pipeline: language, quality, near copies, repeated passages, packing. Each stage's result is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, language, line_dedup, packing, quality
from tidemark.llm.common import boxed, release, row_keys, staged, step, table, unboxed, workspace


@step
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: no text, no letter, or no language that holds a third of it."""
    own = ["doc_id", "text", "lang"]
    found = language.identify(boxed(docs, *own), keep=["text", "lang", "box"]).where("lang_pred <> 'und' and score >= 0.34")
    return unboxed(found, docs.columns, *own)


@step
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the calibrated cutoffs reject go. The texts are measured once, and staged with their counts."""
    own = ["doc_id", "text", "lang"]
    measures = staged(quality.measured(boxed(docs, *own)), "quality-measures")
    cutoffs = staged(quality.calibrate(measures, table(spark, sf_dir, "labels")), "quality-cutoffs")
    return unboxed(quality.judged(measures, cutoffs).where("kept"), docs.columns, *own)


@step
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the one with the smallest (doc_id, text hash) stays, nulls last; of rows equal in id and text, one."""
    found = staged(jaccard_join.join(docs).select("k_id", "k_text", "root", F.col("doc_id").isNull().alias("unnamed")), "near-copies")
    least = found.where("root is not null").groupBy("root").agg(F.min(F.struct("unnamed", "k_id", "k_text")).alias("least")).select("least.k_id", "least.k_text")
    found = found.where("root is null").select("k_id", "k_text").unionByName(least).distinct()
    keyed = boxed(docs, "doc_id", "text").withColumns(row_keys()).join(found, ["k_id", "k_text"], "left_semi")
    return unboxed(keyed.dropDuplicates(["k_id", "k_text"]), docs.columns, "doc_id", "text")


@step
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out; documents that have no word left go. n_chars, where there is one, is counted again."""
    out = line_dedup.dedup(boxed(docs, "doc_id", "text")).withColumn("text", F.col("clean_text")).where("text rlike '\\\\S'")
    out = unboxed(out, docs.columns, "doc_id", "text")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


@step
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("best_fit_packing", best_fit_packing),
]
#: SQL can't express the stages (tokenizer, fitted language model); tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with workspace(spark) as kept:  # what a stage staged on its way goes once its result is written
            out = staged(stage(spark, docs, sf_dir), name)
            kept.append(out)
        if name != STAGES[0][0]:
            release(docs)
        docs = out
    return docs
