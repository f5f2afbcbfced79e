"""Operator 6: removal of repeated passages by hashing lines, clauses and windows of words.

A text is looked at as words in small letters, in three ways. Each makes entries, 64-bit hashes that are met globally:
an entry is a repeat if the same one is in a document earlier in order of (doc_id, text hash), or earlier in its own.

1. *Windows* of ten words, at every word. Neighbouring repeats make a run; its words go if they are `min_words` or
   more. So every passage of `min_words` words that stands earlier as a whole goes, wherever it begins and ends.
2. *Clauses*, the pieces between line ends and marks (.,;:!?) that white space follows. Runs of neighbouring repeats go
   if they hold `min_words` words, `solid_words` of them in clauses of four words or more: these also hold what was
   put together from clauses of several documents.
3. *Whole lines and paragraphs* (lines between blank ones) of `line_words` words or more go by themselves.

Offsets (in characters of the original text) of what was removed are kept.

A task packs its documents in chunks and sends an entry once for all of a chunk's documents, 40 bits of it to one of
the buckets that the rest chooses (their number grows with the text); a run needs eleven windows and a line is held by
two entries, so a chance collision removes nothing but, once in hundreds of thousands of run ends, one more word.
Documents get one bit per entry back.

Nulls: a null text has no words and stays null. A null doc_id ranks before all others. Rows equal in id and text are one
document and get the same result each; of other rows that share an id, or have none, exactly one keeps each entry.
Texts are taken whole; one with more entries than a chunk makes a chunk alone. An empty table gives an empty one. Other
columns come along, but for those that have the name of a result, which the result replaces.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import boxed, claim_cache, partitions, row_keys, staged, tidied, unboxed

EDGE = re.compile(r"\n|[.,;:!?](?=\s)")
WORD = re.compile(r"\S+")
#: Words of a window, entries of a chunk of documents, and bytes of text that a bucket is made for.
WINDOW, CHUNK, BUCKET = 10, 1_000_000, 16 << 20
RESULTS = ["clean_text", "n_units", "n_removed", "removed_spans"]
MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
NONE = np.empty(0, np.uint64)


class _WordHash(dict):
    """Signed 64-bit hashes; the lowest bit is set if a clause ends with the word."""

    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) >> 1 << 1 | (word[-1] in ".,;:!?")
        self[word] = h = h - (1 << 64) if h >> 63 else h
        return h


_word_hash = _WordHash()


def units(text: str) -> list[tuple[int, int, int, bytes]]:
    """(start, end, words, digest) of the clauses, in order; they cover the text."""
    out, at = [], 0
    for end in [*[m.end() for m in EDGE.finditer(text)], len(text)]:
        if end > at:
            words = text[at:end].lower().split()
            out.append((at, end, len(words), xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass")) if words else b""))
            at = end
    return out


def lines(text: str, line_words: int) -> tuple[list[str], list[int], list[tuple[int, int]]]:
    """The words, where lines end, and which words ([start, end)) are whole lines, and paragraphs of several lines, of line_words or more."""
    words, ends, found, begin, n = [], [], [], 0, 0
    for line in [*text.lower().split("\n"), ""]:
        a = len(words)
        words += line.split()
        if len(words) > a:
            n += 1
            ends.append(len(words))
            if len(words) - a >= line_words:
                found.append((a, len(words)))
        else:
            if n > 1 and a - begin >= line_words:
                found.append((begin, a))
            begin, n = a, 0
    return words, ends, found


def _mixed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    h = x * MIX[0] + y * MIX[1]
    h ^= h >> np.uint64(32)
    h *= MIX[0]
    return h ^ (h >> np.uint64(29))


def windows(a: np.ndarray) -> np.ndarray:
    """Hashes of the windows of ten words, from the words' hashes."""
    if len(a) < WINDOW:
        return NONE
    two = _mixed(a[:-1], a[1:])
    four = _mixed(two[:-2], two[2:])
    eight = _mixed(four[:-4], four[4:])
    return _mixed(eight[:-2], two[8:])


@lru_cache(64)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and their inverses modulo 2**64."""
    return tuple(np.multiply.accumulate(np.array([1, *[b] * (n - 1)], np.uint64)) for b in (base, pow(base, -1, 1 << 64)))


def stretches(a: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hashes of stretches of words, from the words' hashes."""
    power, inverse = _powers(int(base), 1 << len(a).bit_length())
    sums = np.concatenate((NONE, [np.uint64(0)], np.cumsum(a * power[: len(a)])))
    return _mixed((sums[end] - sums[start]) * inverse[start], (end - start).astype(np.uint64))


def entries(text: str | None, line_words: int) -> np.ndarray:
    """Windows, then clauses with words, then the lines by two hashes each."""
    words, ends, found = lines(text or "", line_words)
    if not words:
        return NONE
    a = np.array(list(map(_word_hash.__getitem__, words)), np.int64).view(np.uint64)
    last = (a & np.uint64(1)).astype(bool)
    last[np.array(ends) - 1] = True
    end = np.flatnonzero(last) + 1
    i, j = np.array(found, np.int64).reshape(-1, 2).T
    return np.concatenate([windows(a), stretches(a, np.append(0, end[:-1]), end, MIX[1]), *(stretches(b, i, j, MIX[0]) for b in (a, _mixed(a, a)))])


def removed(found: list[tuple[int, int, int, bytes]], repeat: set[int], min_words: int, solid_words: int) -> list[tuple[int, int]]:
    """Spans to remove, given which units are repeats. Units without words go with the run they stand in."""
    spans, run = [], []

    def close():
        while run and not found[run[-1]][2]:
            run.pop()
        if sum(found[i][2] for i in run) >= min_words and sum(found[i][2] for i in run if found[i][2] >= 4) >= solid_words:
            spans.append((found[run[0]][0], found[run[-1]][1]))
        run.clear()

    for i, u in enumerate(found):
        if i in repeat or (run and not u[2]):
            run.append(i)
        else:
            close()
    close()
    return spans


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def cut(text: str, repeat: np.ndarray, min_words: int, solid_words: int, line_words: int) -> list[tuple[int, int]]:
    """Spans of the text to remove, given which of its entries are repeats."""
    words, _, found = lines(text, line_words)
    own, at = units(text), [m.span() for m in WORD.finditer(text)]
    n, w, c, k = len(words), max(0, len(words) - WINDOW + 1), sum(u[2] > 0 for u in own), len(found)
    gone = np.zeros(n, bool)
    for i, j in _runs(repeat[:w]):
        if j - i + WINDOW - 1 >= min_words:
            gone[i : j + WINDOW - 1] = True
    with_words = [i for i, u in enumerate(own) if u[2]]
    starts = [s for s, _ in at]
    for a, b in removed(own, {with_words[i] for i in np.flatnonzero(repeat[w : w + c])}, min_words, solid_words):
        gone[np.searchsorted(starts, a) : np.searchsorted(starts, b)] = True
    for i in np.flatnonzero(repeat[w + c : w + c + k] & repeat[w + c + k : w + c + 2 * k]):
        gone[slice(*found[i])] = True
    spans = []
    for i, j in _runs(gone):
        (a, _), (_, b) = at[i], at[j - 1]
        before, after = at[i - 1][1] if i else 0, at[j][0] if j < n else len(text)
        line_end = text.find("\n", b, after)
        if line_end < 0:  # up to the next word, or the text's end
            b = after
        elif not i or "\n" in text[before:a]:  # whole lines, with their end
            a, b = max(before, text.rfind("\n", before, a) + 1), line_end + 1
        spans.append((a, b))
    return spans


def _small(a: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the largest needs; _wide reads them."""
    top = int(a.max()) if len(a) else 0
    return a.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8").tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, {1: "u1", 2: "<u2", 4: "<u4", 8: "<u8"}[len(data) // n] if n else "u1").astype(np.int64)


def _rising(a: np.ndarray) -> bytes:
    """Rising 64-bit numbers: the first, then the steps. _risen reads them."""
    return a[:1].astype("<i8").tobytes() + _small(np.diff(a.view(np.uint64)))


def _risen(data: bytes, n: int) -> np.ndarray:
    first = np.frombuffer(data[:8], "<i8")
    return np.cumsum(np.concatenate((first, _wide(data[8:], n - 1)))) if n > 1 else first


def _steps(at: np.ndarray) -> bytes:
    """Rising places as steps of one byte; 255 stands for 255 and a further byte."""
    step = np.diff(at, prepend=0)
    out = np.full(int((step // 255 + 1).sum()), 255, np.uint8)
    out[np.cumsum(step // 255 + 1) - 1] = step % 255
    return out.tobytes()


def _places(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


def _sorted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the numbers in rising order, equal ones as they stand, four bytes each; and which of these are the first of their number."""
    order = np.argsort(h, kind="stable").astype(np.uint32)
    h = h[order]
    return order, np.concatenate(([True], h[1:] != h[:-1]))


PACKED = "chunk long, bucket int, ids binary, keys binary, counts binary, low binary, mid binary, at binary"


def _chunks(docs: DataFrame, buckets: int, line_words: int) -> DataFrame:
    """Rows of two kinds: the documents of a chunk, their counts of entries and the bits of those repeated within it (low is null), and of each bucket the entries, by document."""

    def run(batches):
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        claim_cache("passage words", _word_hash.clear)
        held, size = {}, 0

        def flush():
            keys = sorted(held)
            lens = np.array([len(held[k]) for k in keys], np.int64)
            h = np.concatenate([held.pop(k) for k in keys])
            ids, texts = (np.array(x, "<i8") for x in zip(*keys))
            # Documents are in order, so of equal entries the first one is the earliest. Arrays as long as the chunk are few and narrow.
            order, first = _sorted(h)
            again = np.zeros(len(h), bool)
            again[order[~first]] = True
            del order, first
            at = np.flatnonzero(~again).astype(np.uint32)
            h, who = h[at], np.repeat(np.arange(len(keys), dtype=np.uint32), lens)[at]
            bucket = h >> np.uint64(40)
            bucket %= np.uint64(buckets)
            bucket = bucket.astype(np.min_scalar_type(buckets))
            edges = np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=buckets))))
            order = np.argsort(bucket, kind="stable").astype(np.uint32)
            del bucket
            chunk = (part << 32) + count
            rows = [(chunk, chunk % buckets, ids.tobytes(), texts.tobytes(), lens.tobytes(), None, None, np.packbits(again).tobytes())]
            for b in range(buckets):
                mine = order[edges[b] : edges[b + 1]]
                if len(mine):
                    n = np.bincount(who[mine], minlength=len(keys))
                    has, x = n > 0, h[mine]
                    rows.append((chunk, b, _rising(ids[has]), (texts[has].view(np.uint64) >> np.uint64(8)).astype("<u4").tobytes(), _small(n[has]), x.astype("<u4").tobytes(), (x >> np.uint64(32)).astype("u1").tobytes(), _steps(at[mine].astype(np.int64))))
            del h, who, at, order
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int32()] + [pa.binary()] * 6)], names=[x.split()[0] for x in PACKED.split(", ")])

        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                for k_id, k_text, text in zip(*(batch.column(i).slice(a, 256).to_pylist() for i in range(3)), strict=True):
                    if (k_id, k_text) not in held and len(x := entries(text, line_words)):
                        held[k_id, k_text] = x
                        size += len(x)
                if size >= CHUNK:
                    yield flush()
                    count += 1
                    size = 0
        if held:
            yield flush()

    return docs.select("k_id", "k_text", "text").mapInArrow(tidied(run), PACKED)


def _meet(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of a bucket: the entries of each chunk that are in an earlier document, and the rows of chunks as they are."""
    heads, rows = pdf[pdf["low"].isnull()], pdf[pdf["low"].notnull()]
    out = [(r.chunk, r.ids, r.keys, r.counts, r.at) for r in heads.itertuples()]
    if len(rows):
        read = lambda c, t: [np.frombuffer(x, t) for x in rows[c]]
        keys, low = read("keys", "<u4"), read("low", "<u4")  # of a text's hash 32 bits: they only part rows that share an id
        ids = [_risen(x, len(k)) for x, k in zip(rows["ids"], keys)]
        k_id, k_text = np.concatenate(ids), np.concatenate(keys)
        order = np.lexsort((k_text, k_id))
        new = (np.diff(k_id[order]) != 0) | (np.diff(k_text[order]) != 0)
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.concatenate(([0], np.cumsum(new)))
        del k_id, k_text, order, new
        rank = np.repeat(rank, np.concatenate([_wide(x, len(i)) for x, i in zip(rows["counts"], ids)]))
        h = np.concatenate(read("mid", "u1")).astype(np.uint64)
        h <<= np.uint64(32)
        h |= np.concatenate(low)
        order, first = _sorted(h)
        del h
        rank = rank[order]
        first = np.flatnonzero(first)
        least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(rank))))
        repeat = np.zeros(len(rank), bool)
        repeat[order] = rank > least
        del order, first, rank, least
        edges = np.cumsum([len(x) for x in low])[:-1]
        for chunk, at, x, mine in zip(rows["chunk"], rows["at"], low, np.split(repeat, edges)):
            if mine.any():
                out.append((chunk, None, None, None, _places(at)[mine].astype("<u4").tobytes()))
    return pd.DataFrame(out, columns=["chunk", "ids", "keys", "counts", "at"])


def _verdict(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of a chunk: the documents with repeats and the bits of these."""
    head = pdf[pdf["ids"].notnull()].iloc[0]
    ends = np.cumsum(np.frombuffer(head["counts"], np.int64))
    repeat = np.unpackbits(np.frombuffer(head["at"], np.uint8))[: ends[-1]].astype(bool)
    for x in pdf["at"][pdf["ids"].isnull()]:
        repeat[np.frombuffer(x, "<u4")] = True
    rows = [(i, k, np.packbits(r).tobytes()) for i, k, r in zip(np.frombuffer(head["ids"], "<i8"), np.frombuffer(head["keys"], "<i8"), np.split(repeat, ends[:-1])) if r.any()]
    return pd.DataFrame(rows, columns=["k_id", "k_text", "_repeats"])


def dedup(docs: DataFrame, *, min_words: int = 20, solid_words: int = 12, line_words: int = 4) -> DataFrame:
    """The rows of docs with clean_text, n_units (clauses), n_removed and removed_spans (array of [start, end))."""
    columns = [c for c in docs.columns if c not in RESULTS]
    keyed = boxed(docs.select(*[f"`{c}`" for c in columns]), "doc_id", "text").withColumns(row_keys())
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    met = _chunks(keyed, max(partitions(docs.sparkSession), size // BUCKET), line_words).groupBy("bucket").applyInPandas(_meet, "chunk long, ids binary, keys binary, counts binary, at binary")
    repeats = met.groupBy("chunk").applyInPandas(_verdict, "k_id long, k_text long, _repeats binary").dropDuplicates(["k_id", "k_text"])
    repeats = staged(repeats, "passage-repeats", rows=1000)  # written before texts are dealt out for the join, so that both don't take memory at once
    rows = keyed.join(repeats, ["k_id", "k_text"], "left").select("doc_id", "text", "box", "_repeats")

    def rewrite(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                texts, spans, counts = [], [], []
                for text, bits in zip(batch.column("text").to_pylist(), batch.column("_repeats").to_pylist(), strict=True):
                    gone = cut(text, np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool), min_words, solid_words, line_words) if bits else []
                    at, parts = 0, []
                    for a, b in gone:
                        parts.append(text[at:a])
                        at = b
                    texts.append(None if text is None else "".join([*parts, text[at:]]))
                    spans.append([list(s) for s in gone])
                    ends = [m.end() for m in EDGE.finditer(text or "")]
                    counts.append((len(ends) + ((ends[-1] if ends else 0) < len(text or "")), len(gone)))
                more = [pa.array(texts, pa.string()), pa.array([c[0] for c in counts], pa.int64()), pa.array([c[1] for c in counts], pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64())))]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "text", "box")], *more], names=["doc_id", "text", "box", *RESULTS])

    kinds = dict(rows.dtypes)
    out = rows.mapInArrow(tidied(rewrite), f"doc_id {kinds['doc_id']}, text {kinds['text']}, box {kinds['box']}, clean_text string, n_units long, n_removed long, removed_spans array<array<long>>")
    return unboxed(out, columns, "doc_id", "text", more=RESULTS)
