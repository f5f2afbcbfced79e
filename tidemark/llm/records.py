"""Operator 2: token ids as length-delimited binary records with masked checksums and a separate offset index.

A file is a run of records, all little-endian:

    length   u64   bytes of the payload
    masked   u32   masked CRC-32 of the 8 length bytes
    payload        id u64 (2**63 where it is null; signed otherwise), width u8 (2 or 4), then the token ids in `width` bytes each
    masked   u32   masked CRC-32 of the payload
    end      0x0A

masked(c) = ((c >> 15 | c << 17) + 0xa282ead8) mod 2**32, so that checksums of data holding checksums stay good.

Files are written and read by Spark alone (its text writer, with the frame as raw bytes, and its binaryFile reader),
so any store and Spark's commit protocol serve, and a lost executor leaves no half-written file behind. Documents
are dealt by ranges of (id, text hash) into shards, one file each, of about `shard_bytes` of text, counted first: shard n
holds none that ranks after those of shard n + 1. A reader holds a shard at a time, so it needs memory for one of these.
The index (Parquet: shard, file, pos, doc_id, offset, length, n_tokens) holds the place of each record; `read_at` picks
records by it in any order, and opens no file but those that hold them.

Nulls: a null text is an empty one (only the end id); a null id sorts first. Rows of one id are ordered by the hash of
their text; repeated rows are written again each. A text longer than a shard is one record, whole. An empty table gives
no records. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import LibraryEncoder, encoder
from tidemark.llm.common import scratch, tidied, tokenizer_file

END = b"\n"
NULL_ID = -(2**63)


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or int(ids.max()) < 65536 else 4
    payload = struct.pack("<qB", NULL_ID if doc_id is None else doc_id, width) + ids.astype(f"<u{width}").tobytes()
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(head)) + payload + struct.pack("<I", masked(payload)) + END


def frames(data: bytes | memoryview):
    """(offset, whole length, id, token ids) of each record; raises ValueError where a checksum doesn't hold."""
    at = 0
    while at < len(data):
        head = data[at : at + 8]
        if len(head) < 8 or struct.unpack_from("<I", data, at + 8)[0] != masked(head):
            raise ValueError(f"bad length at {at}")
        n = struct.unpack("<Q", head)[0]
        payload = data[at + 12 : at + 12 + n]
        if len(payload) < n or struct.unpack_from("<I", data, at + 12 + n)[0] != masked(payload) or data[at + 16 + n : at + 17 + n] != END:
            raise ValueError(f"bad record at {at}")
        doc_id, width = struct.unpack_from("<qB", payload)
        yield at, 17 + n, None if doc_id == NULL_ID else doc_id, np.frombuffer(payload, f"<u{width}", offset=9).astype("<u4")
        at += 17 + n


def write_records(docs: DataFrame, path: str, *, end_id: int = 2, tokenizer: str | None = None, shard_bytes: int = 32 << 20) -> None:
    """Encode the texts in ascending order of doc_id and write them as record files under path, one for each shard."""
    tokenizer = tokenizer or tokenizer_file()

    def run(batches):
        lib = encoder(LibraryEncoder, tokenizer)
        for batch in batches:
            for a, b, ids, starts in lib.segments(batch.column(1), end_id):
                names = batch.column(0).slice(a, b - a).to_pylist()
                out = [frame(d, ids[i:j])[: -len(END)] for d, i, j in zip(names, starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                for i in range(0, len(out), 1024):
                    yield pa.RecordBatch.from_arrays([pa.array(out[i : i + 1024], pa.binary())], names=["frame"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tie"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = rows.repartitionByRange(1 + size // shard_bytes, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    # The writer's line end is the record's last byte. A task's file carries its number, which is the shard's.
    dealt.mapInArrow(tidied(run), "frame binary").select(F.col("frame").cast("string").alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", 0).text(path)


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1)
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(paths).select(F.regexp_extract(name, r"^part-(\d+)", 1).cast("int").alias("shard"), name.alias("file"), "content")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record, its checksums proved: shard, file, pos, doc_id, offset, length, n_tokens, ids (u32 little-endian)."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                shard, file, rows = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), []
                for pos, (at, n, d, ids) in enumerate(frames(memoryview(batch.column(2)[i].as_buffer()))):
                    rows.append((shard, file, pos, d, at, n, len(ids), ids.tobytes()))
                    if len(rows) == 1024:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    names = ["shard", "file", "pos", "doc_id", "offset", "length", "n_tokens", "ids"]
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return _files(spark, path).mapInArrow(tidied(run), "shard int, file string, pos long, doc_id long, offset long, length long, n_tokens long, ids binary")


def write_index(spark: SparkSession, path: str, index: str) -> DataFrame:
    """The offset index of the record files, with the digest of each record's ids; returned as read back."""
    out = read_records(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    out.write.parquet(index)
    return spark.read.schema(out.schema).parquet(index)


def read_at(wanted: DataFrame, path: str) -> DataFrame:
    """The records at rows (file, offset, length) of an index, in any order: doc_id, ids. Files are cut in the JVM; only those asked for are read (their names, one for each shard at most, come to the driver)."""
    found = [f"{path}/{r.file}" for r in wanted.select("file").distinct().collect()]
    if not found:
        return wanted.sparkSession.createDataFrame([], "doc_id long, ids array<long>")
    cut = wanted.join(_files(wanted.sparkSession, found).drop("shard"), "file").select(F.expr("substring(content, cast(offset + 1 as int), cast(length as int))").alias("frame"))

    def run(batches):
        for batch in batches:
            got = [next(frames(x)) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([g[2] for g in got], pa.int64()), pa.array([g[3] for g in got], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return cut.mapInArrow(run, "doc_id long, ids array<long>")


def starts(index: DataFrame) -> DataFrame:
    """The index with `start`: ids of all documents before. Sums per shard first, so only one row a shard meets in the running sum."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = Window.partitionBy("shard").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return index.join(base.select("shard", "base"), "shard").withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))


def records(docs: DataFrame, *, tokenizer: str | None = None) -> DataFrame:
    """Write the files and their index into the shared folder and give, from them, a row per document."""
    spark = docs.sparkSession
    path = scratch(spark, "records")
    write_records(docs, path, tokenizer=tokenizer)
    index = write_index(spark, path, path + "-index")
    return starts(index).select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "offset", "length")
