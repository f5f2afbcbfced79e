"""Operator 7: exact top-k inner products by an impact-ordered index, score at a time.

Vectors become integers, floor(256 x). They are dealt into blocks; a block's index has, per component, its vectors
ordered by value and cut into posting segments of equal quantised value. A query takes the segments of all components
by descending impact, the most that a posting of the segment can add to its score, and adds that to the accumulators of
the segment's vectors. What a vector still lacks is bounded by its number of open components times the next segment's
impact. Every few segments, inside the positive impacts as after them, the best accumulators are rescored exactly for a
threshold; scanning ends only once all but a few vectors are proved to lie below it, and these few are rescored exactly.
So the result is exact whatever the data; on data that offers no bound all segments are read.

Each block goes to one task, the queries to every block (a stated query set against all rows, in blocks): a task reads
the block, makes its index once and takes the groups of queries one after the other, so it holds one of each.

Rows whose vector is null or holds null or non-finite components, or whose vec_id is null, take no part. Rows with the
query's own vec_id are not its candidates. Vectors shorter than others count as filled up with zeros, whatever their
length. Repeated rows are candidates and queries again each; equal scores go by the smaller id. An empty table gives an
empty result. Other columns are not looked at, whatever their names. Products beyond 2**62 are summed in exact numbers
of any size; a score that the result's 64 bits can't hold is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, tidied

SHIFT = 4
#: Proof tests among the segments of positive impact, and after them.
TESTS, LATER = 12, 6


class Block:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.v = ids, vectors.astype(np.int64)
        self.by, self.cuts = [], []
        self.top_value = int(np.abs(self.v).max()) if self.v.size else 0
        for d in range(self.v.shape[1]):
            col = self.v[:, d]
            order = np.argsort(col, kind="stable")
            level = col[order] >> SHIFT
            edges = np.concatenate(([0], np.nonzero(np.diff(level))[0] + 1, [len(order)])) if len(order) else np.zeros(1, np.int64)
            self.by.append(order)
            self.cuts.append(edges)
        self.low = [self.v[o[e[:-1]], d] for d, (o, e) in enumerate(zip(self.by, self.cuts))]
        self.high = [self.v[o[e[1:] - 1], d] for d, (o, e) in enumerate(zip(self.by, self.cuts))]

    def top(self, query_id: int, q: np.ndarray, k: int, few: int = 64) -> list[tuple[int, int]]:
        """(score, vec_id), best first, ties to the smaller id."""
        n, dims = self.v.shape
        few, own = max(few, 4 * k), self.ids == query_id
        if n - own.sum() <= 2 * max(few, k) or self.top_value * int(np.abs(q).max()) * dims > 2**52:
            return self._exact(np.nonzero(~own)[0], q, k)
        impact, comp, seg = [], [], []
        for d in range(dims):
            if q[d]:
                impact.append(q[d] * (self.high[d] if q[d] > 0 else self.low[d]))
                comp.append(np.full(len(self.low[d]), d))
                seg.append(np.arange(len(self.low[d])))
        if not impact:
            return self._exact(np.nonzero(~own)[0], q, k)
        impact, comp, seg = np.concatenate(impact), np.concatenate(comp), np.concatenate(seg)
        order = np.argsort(-impact, kind="stable")
        impact, comp, seg = impact[order], comp[order], seg[order]
        # Between two tests the segments are summed at once.
        up = int(np.searchsorted(-impact, 0))
        steps = [*np.linspace(0, up, TESTS + 1).astype(int).tolist(), *np.linspace(up, len(order), LATER + 1).astype(int).tolist()[1:]]
        acc, left = np.zeros(n), np.full(n, np.count_nonzero(q), np.int64)
        by, cuts, maybe = self.by, self.cuts, np.nonzero(~own)[0]
        for a, b in zip(steps, steps[1:]):
            if a < b:
                at = [by[d][cuts[d][s] : cuts[d][s + 1]] for d, s in zip(comp[a:b].tolist(), seg[a:b].tolist())]
                ids = np.concatenate(at)
                acc += np.bincount(ids, np.repeat(impact[a:b].astype(float), [len(x) for x in at]), n)
                left -= np.bincount(ids, minlength=n)
            elif b < len(order):
                continue
            most = acc + left * (float(impact[b]) if b < len(order) else 0.0)
            most[own] = -np.inf
            best = np.argpartition(-most, few)[:few]
            best = best[~own[best]]
            threshold = np.sort(self.v[best] @ q)[-k]
            maybe = np.nonzero(most >= threshold)[0]
            if len(maybe) <= 8 * few:
                break
        return self._exact(maybe, q, k)

    def _exact(self, at: np.ndarray, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        v, ids = self.v[at], self.ids[at]
        if self.top_value * int(np.abs(q).max() if len(q) else 0) * len(q) > 2**62:
            big = sorted(((-sum(x * y for x, y in zip(r, q.tolist())), i) for r, i in zip(v.tolist(), ids.tolist())))[:k]
            if any(abs(s) >= 2**63 for s, _ in big):
                raise OverflowError("a score doesn't fit into 64 bits")
            return [(-s, i) for s, i in big]
        scores = v @ q
        best = np.lexsort((ids, -scores))[:k]
        return [(int(scores[i]), int(ids[i])) for i in best]


def _quantised(rows: DataFrame) -> DataFrame:
    good = "vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    return rows.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), F.expr("transform(embedding, x -> cast(floor(256 * cast(x as double)) as bigint))").alias("v"))


def _kind(m: np.ndarray) -> str:
    """The smallest integers that hold the numbers."""
    top = max(int(m.max()), -int(m.min())) if m.size else 0
    return "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8"


def _blocks(rows: DataFrame, n: int, most: int) -> DataFrame:
    """Rows (part, ids, dims, kind, data), each of at most `most` vectors."""

    def run(batches):
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        vs: list[list[int]] = []

        def flush():
            dims = max(map(len, vs))
            m = np.zeros((len(vs), dims), np.int64)
            for i, v in enumerate(vs):
                m[i, : len(v)] = v
            cols = [[part + n * count], [np.array(ids, "<i8").tobytes()], [dims], [_kind(m)], [m.astype(_kind(m)).tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.binary(), pa.int32(), pa.string(), pa.binary()])], names=PACKED)

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                for i, v in zip(*(batch.column(c).slice(at, 1024).to_pylist() for c in (0, 1)), strict=True):
                    ids.append(i)
                    vs.append(v)
                    if len(ids) == most:
                        yield flush()
                        count += 1
                        ids, vs = [], []
        if ids:
            yield flush()

    return rows.repartition(n).mapInArrow(run, "part long, ids binary, dims int, kind string, data binary")


PACKED = ["part", "ids", "dims", "kind", "data"]


def _vectors(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["data"], row["kind"]).reshape(-1, row["dims"]).astype(np.int64)


def search(vectors: DataFrame, *, every: int = 50, k: int = 5, block: int = 8192, group: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score of the k best for each row whose vec_id `every` divides."""
    rows = _quantised(vectors)
    asked = rows.where(F.col("vec_id") % every == 0)
    n_rows, n_asked = rows.count(), asked.count()
    index = staged(_blocks(rows, max(1, -(-n_rows // block)), 2 * block), "search-index")
    queries = staged(_blocks(asked, max(1, -(-n_asked // group)), 2 * group), "search-queries")
    last = index.agg(F.max("part")).first()[0]
    # A block before its queries, which come group by group.
    mine = index.withColumns({"block": F.col("part"), "asked": F.lit(0)})
    theirs = queries.withColumns({"block": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last or 0).cast("long"))), "asked": F.lit(1)})
    dealt = mine.unionByName(theirs).repartition((last or 0) + 1, "block").sortWithinPartitions("block", "asked", "part")

    def run(batches):
        held, number = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in (*PACKED, "block", "asked")}
                ids, v = _vectors(row)
                if not row["asked"]:
                    held, number = Block(ids, v), row["block"]
                elif row["block"] == number:
                    out: list[tuple[int, int, int, int]] = []
                    dims = held.v.shape[1]
                    v = np.pad(v, ((0, 0), (0, max(0, dims - v.shape[1]))))[:, :dims]  # what the block's vectors lack counts as zero
                    for n, (q_id, q) in enumerate(zip(ids.tolist(), v)):
                        out += [(row["part"] * 4 * group + n, q_id, x, s) for s, x in held.top(q_id, q, k)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)], names=["q", "query_id", "vec_id", "score"])

    found = dealt.mapInArrow(tidied(run), "q long, query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
