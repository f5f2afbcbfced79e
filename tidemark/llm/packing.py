"""Operator 5: best-fit packing by length patterns and non-negative least squares.

Only the histogram of piece lengths (at most `capacity` bins, whatever the input) reaches the driver. There patterns
of few documents are enumerated (pairs of lengths with the longest third that fits, and short lengths repeated), repeat
counts fitted to the histogram by non-negative least squares (accelerated projected gradient, the columns kept sparse),
rounded to whole repeats, and what is left goes by best fit, longest first, into the gaps and new sequences. All of this is in counts of equal lengths, so the plan's size depends on the
capacity only. Pieces then find their place by their number among the pieces of their length: no piece is shuffled
with its tokens, and a length that a third of all pieces share is numbered by task, not in one task.

Documents longer than the capacity are cut into pieces of exactly the capacity, the first one taking the remainder.
Nulls: a null text is an empty one (only the end id); a null doc_id is kept. Repeated rows are packed again each. An
empty table packs nothing. Lengths that fit equally well go by the fuller sequence that was opened last. Other columns
are not looked at, whatever their names.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import LibraryEncoder, encoder
from tidemark.llm.common import staged, tidied, tokenizer_file

PIECES = "task int, doc_id long, piece int, start long, length long, ids binary, nth long"


def pieces(docs: DataFrame, *, capacity: int = 2048, end_id: int = 0, tokenizer: str | None = None) -> DataFrame:
    """A row per piece: ids (u32 little-endian) and nth, its number among the task's pieces of its length."""
    tokenizer = tokenizer or tokenizer_file()

    def run(batches):
        from pyspark import TaskContext

        task, lib, seen = TaskContext.get().partitionId(), encoder(LibraryEncoder, tokenizer), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for a, _, ids, starts in lib.segments(batch.column(1), end_id):
                doc, piece, start, length = _cut(np.diff(starts), capacity)
                order = np.argsort(length, kind="stable")
                counts = np.bincount(length, minlength=capacity + 1)
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(length)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(seen, counts)
                seen += counts
                offsets = 4 * np.append(starts[doc] + start, starts[-1])
                for i in range(0, len(doc), ROWS):
                    at, some = offsets[i : i + ROWS + 1], slice(i, i + ROWS)
                    cut = pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at - at[0]).astype(np.int32)), pa.py_buffer(ids[at[0] // 4 : at[-1] // 4].astype("<u4"))])
                    cols = [np.full(len(cut), task), batch.column(0).take(pa.array(a + doc[some])), piece[some], start[some], length[some], cut, nth[some]]
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, kinds)], names=PIECE_NAMES)

    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidied(run), PIECES)


def _cut(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each piece: its document's place, its number, start and length."""
    first = (lengths - 1) % capacity + 1
    counts = 1 + (lengths - first) // capacity
    doc = np.repeat(np.arange(len(lengths)), counts)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    return doc, piece, np.where(piece, first[doc] + (piece - 1) * capacity, 0), np.where(piece, capacity, first[doc])


PIECE_NAMES = [x.split()[0] for x in PIECES.split(", ")]
#: Pieces in a batch sent back.
ROWS = 4096


@lru_cache(2)
def patterns(capacity: int, lengths: tuple[int, ...], most: int = 400_000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns of few documents among the given lengths: rows of three lengths (0: none), and how often the first repeats.

    For every two lengths that go together, the third is the longest that still fits; of a longest length's patterns those
    that leave the least room are kept (none at all, where lengths are many). For a short length also as many of it as
    fit, with the two longest that do after them. Beyond `most`, the fullest ones stay, and one for each longest length.
    """
    ls = np.array(sorted(lengths), np.int32)
    if not len(ls):
        return np.zeros((0, 3), np.int32), np.zeros(0, np.int32)
    fits = np.zeros(capacity + 1, np.int32)  # the longest length up to a room
    fits[ls] = ls
    fits = np.maximum.accumulate(fits)
    rows, times = [], []
    for a in ls[::-1].tolist():
        rest = capacity - a
        b = np.append(ls[ls <= min(a, rest)], 0)[-most // len(ls) - 2 :]
        c = np.where(b > 0, fits[np.minimum(b, rest - b)], 0)
        many = capacity // a
        second = int(fits[capacity - many * a])
        third = int(fits[capacity - many * a - second])
        new = np.stack([np.full(len(b), a, np.int32), b, c], 1)
        waste = rest - b - c
        keep = waste == waste.min()
        rows.append(np.concatenate([new[keep], [[a, second, third]]]).astype(np.int32))
        times.append(np.append(np.ones(int(keep.sum()), np.int32), many))
    pats, times = np.concatenate(rows), np.concatenate(times).astype(np.int32)
    waste = capacity - pats.sum(1) - (times - 1) * pats[:, 0]
    if len(pats) > most:
        first = np.unique(pats[:, 0][::-1], return_index=True)[1]
        keep = np.zeros(len(pats), bool)
        keep[np.argsort(waste, kind="stable")[:most]] = True
        keep[len(pats) - 1 - first] = True
        pats, times = pats[keep], times[keep]
    return pats, times


def fit(hist: np.ndarray, pats: np.ndarray, times: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 that least squares give for pats x = hist, each length weighted by its size, and the room left over being a further row, wanted 0."""
    n, k = len(hist), len(pats)
    if not k:
        return np.zeros(0)
    w2 = (np.arange(n) / n) ** 2
    scale = max(1.0, float(hist.max()))
    h = hist / scale
    h[0] = 0

    def up(x):  # of each length, how many the repeats use
        out = np.bincount(pats[:, 0], x * times, n) + np.bincount(pats[:, 1], x, n) + np.bincount(pats[:, 2], x, n)
        out[0] = 0
        return out

    def down(r):
        return times * r[pats[:, 0]] + r[pats[:, 1]] + r[pats[:, 2]]

    v = np.random.default_rng(0).random(k)
    for _ in range(30):  # largest eigenvalue, for the step
        v = down(w2 * up(v))
        v /= (top := np.linalg.norm(v)) or 1.0
    step = 1 / (1.05 * top) if top else 1.0
    x = y = np.zeros(k)
    t = 1.0
    for _ in range(rounds):
        z = np.maximum(0, y - step * down(w2 * (up(y) - h)))
        s = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = z + (t - 1) / s * (z - x), z, s
    return x * scale


def rounded(hist: np.ndarray, pats: np.ndarray, times: np.ndarray, x: np.ndarray) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Whole repeats of the patterns within the histogram, and what is left of it. What one pattern's count has beyond a whole number is carried to the next, the patterns of a longest length being neighbours."""
    left, out, carry = hist.astype(np.int64).tolist(), [], 0.0
    at = np.flatnonzero(x > 1e-4)
    for (a, b, c), m, share in zip(pats[at].tolist(), times[at].tolist(), x[at].tolist()):
        carry = min(carry, 1.0) + share
        if carry < 1:
            continue
        need = {a: m}
        for q in (b, c):
            if q:
                need[q] = need.get(q, 0) + 1
        if (n := min(int(carry), *(left[q] // k for q, k in need.items()))) > 0:
            carry -= n
            out.append(((a,) * m + tuple(q for q in (b, c) if q), n))
            for q, k in need.items():
                left[q] -= n * k
    return out, np.array(left, np.int64)


def plan(hist: np.ndarray, capacity: int, shares: tuple[float, ...] = (1.0, 0.9, 0.75)) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences), using up the histogram exactly. Of the shares of the fitted counts that are rounded, the one that needs the fewest sequences in all is taken, ties to the largest: what is left needs some choice of lengths to fill gaps."""
    left = hist.astype(np.int64).copy()
    left[0] = 0
    pats, times = patterns(capacity, tuple(np.flatnonzero(left).tolist()))
    x = fit(left, pats, times)
    best: list[tuple[tuple[int, ...], int]] | None = None
    for share in shares:
        out, rest = rounded(left, pats, times, share * x)
        filled = residual(rest, capacity, out)
        out = out + filled
        if best is None or sum(n for _, n in out) < sum(n for _, n in best):
            best = out
    return best or []


def residual(left: np.ndarray, capacity: int, opened: list) -> list[tuple[tuple[int, ...], int]]:
    """By best fit, longest first: groups of like sequences by the room they have. Sequences in `opened` that have room are filled up first and leave the list then."""
    rooms: dict[int, list[list]] = defaultdict(list)
    for p, n in [o for o in opened if sum(o[0]) < capacity]:
        rooms[capacity - sum(p)].append([p, n])
    opened[:] = [o for o in opened if sum(o[0]) == capacity]
    rooms = dict(rooms)
    order: list[int] = sorted(rooms)
    for a in range(capacity, 0, -1):
        n = int(left[a])
        while n:
            i = bisect.bisect_left(order, a)
            if i == len(order):
                each = max(1, min(capacity // a, n))
                new = [((a,) * each, n // each)] + ([((a,) * (n % each), 1)] if n % each else [])
                n = 0
                moved = new
            else:
                room = order[i]
                p, have = rooms[room].pop()
                use = min(n, have)
                if have > use:
                    rooms[room].append([p, have - use])
                if not rooms[room]:
                    del rooms[room], order[i]
                moved, n = [((*p, a), use)], n - use
            for p, c in moved:
                room = capacity - sum(p)
                if room not in rooms:
                    rooms[room] = []
                    bisect.insort(order, room)
                rooms[room].append([p, c])
    return [(tuple(p), c) for group in rooms.values() for p, c in group]


def slots(planned: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By length: where runs of its pieces begin, and of each run the first sequence, the repeats' count and the offset."""
    runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    seq = 0
    for p, n in planned:
        at = 0
        for a in p:
            runs[a].append((used[a], seq, n, at))
            used[a] += n
            at += a
        seq += n
    return {a: tuple(np.array(c, np.int64) for c in zip(*r)) for a, r in runs.items()}


def pack(cut: DataFrame, *, capacity: int = 2048, ids: bool = False) -> DataFrame:
    """Places for staged pieces: the rows of `pieces` (staged, so that numbers don't change) with sequence_id and offset and the digest of their ids; the ids themselves only if asked for, else no token is shuffled."""
    spark = cut.sparkSession
    counts = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    hist = np.zeros(capacity + 1, np.int64)
    for a, n in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        hist[a] = n
    where = spark.sparkContext.broadcast(slots(plan(hist, capacity)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    numbered = cut.select("task", "doc_id", "piece", "start", "length", "nth", F.crc32("ids").alias("ids_crc32"), *(["ids"] if ids else [])).join(base, ["task", "length"])

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, number):
        import pandas as pd

        seq, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        length, number = length.to_numpy(), number.to_numpy()
        for a in np.unique(length):
            first, s, _, o = where.value[int(a)]
            mine = length == a
            i = np.searchsorted(first, number[mine], "right") - 1
            seq[mine], off[mine] = s[i] + number[mine] - first[i], o[i]
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    out = numbered.withColumn("at", place("length", F.col("base") + F.col("nth")))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset", *(["ids"] if ids else []))


def sequences(docs: DataFrame, *, capacity: int = 2048, end_id: int = 0, tokenizer: str | None = None) -> DataFrame:
    """The training data: a row for each sequence, sequence_id, ids (u32 little-endian, its pieces in a row), n_tokens and starts (where pieces begin)."""
    placed = pack(staged(pieces(docs, capacity=capacity, end_id=end_id, tokenizer=tokenizer), "pieces"), capacity=capacity, ids=True)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # of at most `capacity` tokens in all
    out = placed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("n_tokens"))
    whole = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), ""))
    return out.select("sequence_id", whole.alias("ids"), "n_tokens", F.transform("parts", lambda p: p["offset"]).alias("starts"))


def packed(docs: DataFrame, *, capacity: int = 2048, end_id: int = 0, tokenizer: str | None = None) -> DataFrame:
    return pack(staged(pieces(docs, capacity=capacity, end_id=end_id, tokenizer=tokenizer), "pieces"), capacity=capacity)
