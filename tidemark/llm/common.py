"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables, by Spark's reader so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a new one of this machine if all of Spark runs in this process, an error otherwise."""
    found = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_tidemark_shared", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = spark._tidemark_shared = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, *, rows: int | None = None) -> DataFrame:
    """Write once, read back: cuts lineage, and lost executors don't change what later steps read. rows: how many at most go to Python at a time, where they hold texts."""
    path, conf, key = scratch(df.sparkSession, name), df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    if rows and not 0 < int(before) <= rows:
        conf.set(key, str(rows))
    try:
        df.write.parquet(path)
    finally:
        if rows:
            conf.set(key, before)
    for paths in getattr(df.sparkSession, "_tidemark_open", ()):
        paths.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        _delete(df.sparkSession, df._tidemark_path)


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


@contextmanager
def tracked(spark: SparkSession) -> Iterator[list[str]]:
    """The paths of what is staged inside."""
    stack = spark._tidemark_open = getattr(spark, "_tidemark_open", [])
    paths: list[str] = []
    stack.append(paths)
    try:
        yield paths
    finally:
        stack[:] = [p for p in stack if p is not paths]


@contextmanager
def workspace(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """What is staged inside goes when the block ends, but for the frames put into the list it gives."""
    kept: list[DataFrame] = []
    with tracked(spark) as paths:
        try:
            yield kept
        finally:
            for path in set(paths) - {df._tidemark_path for df in kept}:
                _delete(spark, path)


def step(f: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage of a pipeline whose results are written and read again: when it begins, what earlier stages of the session staged on their way goes, unless its input still reads it."""

    @wraps(f)
    def run(spark, docs, sf_dir):
        old = getattr(spark, "_tidemark_steps", [])
        files = docs.inputFiles() if old else []
        read = [p for p in old if any(p.rsplit("/", 1)[-1] in x for x in files)]
        for path in old:
            if path not in read:
                _delete(spark, path)
        with tracked(spark) as paths:
            out = f(spark, docs, sf_dir)
        spark._tidemark_steps = read + paths
        return out

    return run


def unused(names: list[str], *wanted: str) -> list[str]:
    """The wanted names, changed where a table has a column of that name already (small and large letters alike)."""
    taken, out = {n.lower() for n in names}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_keys(id_col: str = "doc_id", text_col: str = "text") -> dict[str, Column]:
    """Null-safe key of a document row. Rows equal in id and text are one document to the operators. The lowest bit of k_text is set for a null id."""
    return {
        "k_id": F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))),
        "k_text": F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).bitwiseAND(-2).bitwiseOR(F.col(id_col).cast("long").isNull().cast("long")),
    }


def key_id() -> Column:
    """The doc_id of a row's key."""
    return F.when(~((F.col("k_id") == -(2**63)) & (F.col("k_text").bitwiseAND(1) == 1)), F.col("k_id"))


def boxed(docs: DataFrame, *own: str) -> DataFrame:
    """The own columns, and `box`, a struct of all others, so that no name of theirs can meet one of an operator's."""
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in own]
    return docs.select(*own, F.struct(*others, F.lit(0).alias("none")).alias("box"))


def unboxed(rows: DataFrame, columns: list[str], *own: str, more: list[str] | None = None) -> DataFrame:
    """The columns as they were before boxed(), and those named in more."""
    return rows.select(*[F.col(c) if c in own else F.col(f"box.c{i}").alias(c) for i, c in enumerate(columns)], *(more or []))


_caches: dict[str, Callable[[], None]] = {}


def claim_cache(owner: str, clear: Callable[[], None]) -> None:
    """A Python worker keeps one operator's cache at a time: those of other operators that it ran before are cleared."""
    if others := [n for n in _caches if n != owner]:
        for name in others:
            _caches.pop(name)()
        gc.collect()
        give_back()
    _caches[owner] = clear


def give_back() -> None:
    """Return what Arrow and the C library hold unused to the machine: a Python worker lives on between tasks, beside others and the JVM."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's; other C libraries have none
        trim(0)


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, a function over a task's batches, which gives unused memory back when the task ends."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def gathered(df: DataFrame, source: DataFrame, *, each: int = 64 << 20) -> DataFrame:
    """df in a partition for each 64 MB (by Spark's estimate) of source, from which it was made, but no more than shuffles have. For narrow rows before they are staged: else each task that reads source writes a small file, and for each file Hadoop's local file system starts processes."""
    size = source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(min(1 + size // each, partitions(df.sparkSession)))


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
