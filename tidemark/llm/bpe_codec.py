"""Operator 8: byte-pair encoding and decoding with contiguous rank arrays.

One pass, no shuffle: each task reads its texts, encodes each distinct chunk once and decodes the ids again.
Nulls are empty texts (no ids, empty decoding); repeated rows give repeated results, an empty table an empty one; texts
are taken whole at any length, some megabytes of short ones at a time; other columns don't matter, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import RankEncoder, encoder
from tidemark.llm.common import tidied, tokenizer_file


def encode_decode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """id, ids (array of int) and decoded (the text again) of every row."""
    path = path or tokenizer_file()

    def run(batches):
        bpe = encoder(RankEncoder, path)
        for batch in batches:
            for a, b, ids, starts in bpe.segments(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.astype(np.int32))), pa.array(bpe.decoded(ids, starts), pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tidied(run), "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, *, path: str | None = None) -> DataFrame:
    """What encode_decode gives, as counts and digests: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    path = path or tokenizer_file()

    def run(batches):
        bpe = encoder(RankEncoder, path)
        for batch in batches:
            for a, b, ids, starts in bpe.segments(batch.column(1)):
                sha = [hashlib.sha256(x).hexdigest() for x in bpe.decimal(ids, starts)]
                back = [hashlib.sha256(x.encode()).hexdigest() for x in bpe.decoded(ids, starts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(starts), pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidied(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
