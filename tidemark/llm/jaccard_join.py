"""Operator 3: exact n-gram Jaccard join by pivots and triangle-inequality windows.

The join works in the metric space of Jaccard distances (d = 1 - similarity; links have d <= r = 1/4).

1. *Far documents.* Two sets that link share a member among the first |x| - ceil(3/4 |x|) + 1 of either, whatever
   order all sets are sorted in. Sorted rarest first, a document with that many shingles that no other document has
   is farther than r from every other one, and no pivot is needed to say so. Counting is done on packed 32-bit
   fingerprints per bucket, each task sending a fingerprint once for all its documents; a chance collision only
   keeps a document in.
2. *Regions.* Documents with equal sets become one class. The classes that share a shingle in that prefix are a
   region; its pivot is its most central class, the one with the least share of shingles of its own. Each
   class has the distance to the pivots of its regions computed exactly. Those within r of a pivot are linked to it,
   and components are formed: in a region of near copies nearly all hang on the pivot now.
3. *Windows and recursion.* Classes of one region that aren't in one component yet can still link. By the triangle
   inequality only if their distances to the pivot differ by at most r; only if sizes and the positions of the shared
   shingle allow the overlap (the bounds hold for the first shingle they share, and every pair that passes at any is
   compared). These boundary pairs are replicated to their region and compared exactly. A region with more than
   `region` such classes first recurses: among those outside the pivot's component a new pivot is chosen, until no
   region is as large, a round has left over half of such classes open (more pivots then cost more than the exact
   comparison does) or `rounds` have passed.

Every pair that links is either compared or already in one component, so components are exact. A split by Voronoi
cells of document pivots alone would not do: documents without common shingles are at distance 1 from all pivots,
so the windows would replicate each of them to all regions; step 1 is what replaces it for those.

Nulls and texts without words have an empty set and link with nothing. Rows equal in id and text are one document, of
which each row is returned; a null doc_id never names a component, nor keeps its row from linking. Texts are taken
whole; one with more shingles than a chunk makes a chunk alone. Shingles that are equally rare are ordered by hash,
classes equally central by digest; results depend on neither. An empty table gives an empty one. Other columns are not
looked at, whatever their names. Shingles are compared by 64-bit hashes (a collision of two shingles within one compared
pair has odds of about 1 in 10**13).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import key_id, partitions, release, row_keys, staged, tidied
from tidemark.llm.components import components

#: Odd multipliers of a shingle's words.
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
#: Shingles of a chunk, documents of a chunk (their numbers take two bytes; the highest stands for several), bytes of text cut at once, bytes of text that a bucket is made for.
CHUNK, MOST, SEGMENT, BUCKET = 750_000, 65_000, 2 << 20, 8 << 20
MANY = 0xFFFF
#: The white space that parts words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Byte -> small letter.
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32


def _hashed(words: pa.BinaryArray) -> np.ndarray:
    """uint64 hash of each word; equal words are hashed once."""
    found = words.dictionary_encode()
    return np.fromiter(map(xxhash.xxh64_intdigest, found.dictionary.to_pylist()), np.uint64, len(found.dictionary))[found.indices.to_numpy()]


def _segments(texts: pa.Array, n: int) -> Iterator[list[np.ndarray]]:
    """Of some megabytes of texts at a time: each text's set."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    every, a = np.frombuffer(texts.buffers()[2] or b"", np.uint8) if len(texts) else None, 0
    while a < len(texts):
        b = min(len(texts), max(a + 1, int(np.searchsorted(offsets, offsets[a] + SEGMENT, "right")) - 1))
        data = SMALL[every[offsets[a] : offsets[b]]]
        edges = offsets[a : b + 1] - offsets[a]
        blank = SPACE[data]
        # A word begins where a text does or after white space; without the white space words stand in a row.
        begins = ~blank
        begins[1:] &= blank[:-1]
        inner = edges[(edges > 0) & (edges < len(data))]
        begins[inner] |= ~blank[inner]
        place = np.cumsum(~blank, dtype=np.int32)
        at = place[begins] - 1
        body = np.ascontiguousarray(data[~blank])
        words = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.append(at, len(body)).astype(np.int32)), pa.py_buffer(body)])
        h = _hashed(words)
        count = np.concatenate(([0], np.cumsum(begins, dtype=np.int64)))[edges]
        yield _sets(h, count, words, n)
        a = b


def _sets(h: np.ndarray, count: np.ndarray, words: pa.BinaryArray, n: int) -> list[np.ndarray]:
    m = max(0, len(h) - n + 1)
    x = h[:m] * MIX[0]
    for i in range(1, n):
        x += h[i : i + m] * MIX[i]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    out = []
    for i, j in zip(count[:-1].tolist(), count[1:].tolist()):
        if j - i >= n:
            own = np.sort(x[i : j - n + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif j > i:
            out.append(np.array([xxhash.xxh64_intdigest(b" ".join(words[i:j].to_pylist()), 1)], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def shingle_sets(texts: list[str | None] | pa.Array, n: int = 5) -> list[np.ndarray]:
    """Sorted distinct uint64 hashes of each text's word n-grams (n at most 8); the whole sequence's where it has fewer words."""
    return [s for some in _segments(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), n) for s in some]


def _chunks(docs: DataFrame, buckets: int, n: int) -> DataFrame:
    """Rows of two kinds per chunk of documents: bucket -1 has the documents (keys, set sizes, members shared in the chunk), the others the packed fingerprints of a bucket and whose they are."""

    def run(batches):
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        ids, keys, sets, size = [], [], [], 0

        def flush():
            lens = np.array([len(s) for s in sets], np.uint32)
            h = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            who = np.repeat(np.arange(len(sets), dtype=np.uint16), lens)
            order = np.argsort(h, kind="stable")
            h, who = h[order], who[order]
            first = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.empty(0, bool)
            runs = np.diff(np.append(np.nonzero(first)[0], len(h)))
            many = np.repeat(runs > 1, runs)
            shared = np.bincount(who[many], minlength=len(sets)).astype(np.uint32)
            who[many] = MANY
            h, who = h[first], who[first]
            bucket = ((h >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            low, who, bucket = h[order].astype(np.uint32), who[order], bucket[order]
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            chunk = (part << 32) + count
            rows = [(chunk, -1, np.array(ids, "<i8").tobytes(), np.array(keys, "<i8").tobytes(), lens.tobytes(), shared.tobytes())]
            rows += [(chunk, b, low[i:j].tobytes(), who[i:j].tobytes(), None, None) for b, (i, j) in enumerate(zip(edges, edges[1:])) if i < j]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64(), pa.int32()] + [pa.binary()] * 4)], names=["chunk", "bucket", "a", "b", "c", "d"])

        for batch in batches:
            keys_of, at = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], 0
            for new in _segments(batch.column(2), n):
                while new:
                    # Up to the text that makes the chunk full.
                    full = int(np.searchsorted(size + np.cumsum([len(s) for s in new]), CHUNK)) + 1
                    some, new = new[: min(full, MOST - len(ids))], new[min(full, MOST - len(ids)) :]
                    ids += keys_of[0][at : at + len(some)].tolist()
                    keys += keys_of[1][at : at + len(some)].tolist()
                    sets += some
                    at += len(some)
                    size += sum(map(len, some))
                    if size >= CHUNK or len(ids) >= MOST:
                        yield flush()
                        count += 1
                        ids, keys, sets, size = [], [], [], 0
        if ids:
            yield flush()

    return docs.select("k_id", "k_text", "text").mapInArrow(tidied(run), "chunk long, bucket int, a binary, b binary, c binary, d binary")


def _sized(docs: DataFrame, num: int, den: int, n: int) -> DataFrame:
    """k_id, k_text, n (set size) and near: whether the document's rarest-first prefix holds a shingle that another document has too. A row per row of docs."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packed = staged(_chunks(docs, max(2 * partitions(docs.sparkSession), size // BUCKET), n), "shingle-chunks", rows=1000)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = np.array([len(x) // 4 for x in pdf["a"]])
        h = np.frombuffer(b"".join(pdf["a"]), np.uint32)
        order = np.argsort(h, kind="stable")
        h = h[order]
        same = h[1:] == h[:-1]
        order = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
        who = np.frombuffer(b"".join(pdf["b"]), np.uint16)[order].astype(np.int64)
        row = np.searchsorted(np.cumsum(sizes), order, "right")
        # By row and document: counted once for all rows, then split where a row ends.
        key = np.sort((row << 16 | who)[who != MANY])
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
        counts, key = np.diff(np.append(first, len(key))).astype(np.uint32), key[first]
        ends = np.searchsorted(key >> 16, np.arange(len(pdf) + 1))
        chunks, who = pdf["chunk"].tolist(), (key & 0xFFFF).astype(np.uint16)
        out = [(c, who[i:j].tobytes(), counts[i:j].tobytes()) for c, i, j in zip(chunks, ends[:-1].tolist(), ends[1:].tolist()) if i < j]
        return pd.DataFrame(out, columns=["chunk", "who", "count"])

    found = packed.where("bucket >= 0").select("chunk", "bucket", "a", "b").groupBy("bucket").applyInPandas(meet, "chunk long, who binary, count binary")

    def verdict(docs_: pd.DataFrame, found_: pd.DataFrame) -> pd.DataFrame:
        d = docs_.iloc[0]
        lens = np.frombuffer(d["c"], np.uint32).astype(np.int64)
        shared = np.frombuffer(d["d"], np.uint32).astype(np.int64)
        for w, c in zip(found_["who"], found_["count"]):
            shared[np.frombuffer(w, np.uint16)] += np.frombuffer(c, np.uint32)
        prefix = lens - (num * lens + den - 1) // den + 1
        return pd.DataFrame({"k_id": np.frombuffer(d["a"], "<i8"), "k_text": np.frombuffer(d["b"], "<i8"), "n": lens, "near": (lens > 0) & (lens - shared < prefix)})

    heads = packed.where("bucket = -1").select("chunk", "a", "b", "c", "d")
    out = staged(heads.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInPandas(verdict, "k_id long, k_text long, n long, near boolean"), "shingle-sizes")
    release(packed)
    return out


def _members(docs: DataFrame, n: int) -> DataFrame:
    """k_id, k_text, cls (digest of the set), n, hashes."""

    def run(batches):
        for batch in batches:
            at = 0
            for sets in _segments(batch.column(2), n):
                ends = np.cumsum([0, *map(len, sets)])
                hashes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
                digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sets)), batch.column(1).slice(at, len(sets)), digests, pa.array(np.diff(ends)), hashes], names=["k_id", "k_text", "cls", "n", "hashes"])
                at += len(sets)

    return docs.select("k_id", "k_text", "text").mapInArrow(tidied(run), "k_id long, k_text long, cls binary, n long, hashes array<long>")


def _prefixes(classes: DataFrame, num: int, den: int) -> DataFrame:
    """h, cls, n, own (shingles of no other class), pos: the prefix members that other classes have too, rarest first."""
    posts = classes.select("cls", "n", F.explode("hashes").alias("h"))
    often = posts.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    each = Window.partitionBy("cls")
    ranked = posts.join(often, "h").withColumns({"own": F.col("n") - F.count(F.lit(1)).over(each), "rn": F.row_number().over(each.orderBy("df", "h"))})
    pos = F.col("own") + F.col("rn") - 1
    return ranked.withColumn("pos", pos).where(f"pos < n - cast(ceil({num} * n / {den}) as bigint) + 1").select("h", "cls", "n", "own", "pos")


def _possible(a: str, b: str, num: int, den: int) -> str:
    """SQL: sizes and positions of the shared shingle leave room for an overlap of num/(num+den) of both sizes."""
    return f"{den} * least({a}.n, {b}.n) >= {num} * greatest({a}.n, {b}.n) and {num + den} * (1 + least({a}.n - {a}.pos, {b}.n - {b}.pos) - 1) >= {num} * ({a}.n + {b}.n)"


def _compared(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """x, y with overlap, nx, ny. The side with hubs (y) is joined while rows are narrow."""
    side = lambda c, n, h: classes.select(F.col("cls").alias(c), F.col("n").alias(n), F.col("hashes").alias(h))
    both = pairs.join(side("y", "ny", "hy"), "y").join(side("x", "nx", "hx"), "x")
    return both.select("x", "y", "nx", "ny", F.size(F.array_intersect("hx", "hy")).cast("long").alias("overlap"))


def _linked(num: int, den: int) -> str:
    return f"{den} * overlap >= {num} * (nx + ny - overlap)"


def links(docs: DataFrame, *, n: int = 5, num: int = 3, den: int = 4, region: int = 256, rounds: int = 3) -> tuple[DataFrame, DataFrame]:
    """(a row per row of docs: k_id, k_text, n; a row per key that is near others: k_id, k_text, root) for similarity num / den."""
    docs = docs.select(*[v.alias(k) for k, v in row_keys().items()], F.col("text").cast("string").alias("text"))
    sized = _sized(docs, num, den, n)
    near = sized.where("near").select("k_id", "k_text").distinct()
    members = staged(_members(docs.join(near, ["k_id", "k_text"], "left_semi").select("k_id", "k_text", "text"), n), "shingle-members", rows=1000)
    classes = staged(members.groupBy("cls").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes")), "shingle-classes")
    who = staged(members.select("k_id", "k_text", "cls").distinct(), "shingle-keys")
    release(members)
    prefix = staged(_prefixes(classes, num, den), "shingle-prefixes")
    radius = 1 - num / den

    root = None  # cls, root: components so far
    known = None  # x, y, d, link: distances to pivots
    used = None  # h, y: the pivots so far
    still = None  # open rows of large regions, after the last round
    central = "max(struct(-(own / n) as c, cls as cls, n as n, pos as pos, root as root))"  # least share of its own shingles
    while True:
        rows = prefix.withColumn("root", F.col("cls")) if root is None else prefix.join(root, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        pivots = rows.groupBy("h").agg(F.expr(central).alias("p"))
        if used is not None:
            # Deeper down: the most central class outside the first pivot's component that hasn't been a pivot there, in regions that are still too large.
            open_ = rows.join(pivots.select("h", F.col("p.root").alias("main")), "h").where("root <> main")
            large = open_.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where(f"m > {region}").select("h")
            fresh = staged(open_.join(large, "h").join(used.withColumnRenamed("y", "cls"), ["h", "cls"], "left_anti"), "open-rows")
            before, still, rounds = still, fresh.count(), rounds - 1
            if not still or rounds < 1 or (before is not None and still > before / 2):
                break
            pivots = fresh.groupBy("h").agg(F.expr(central).alias("p"))
        new = pivots.select("h", F.col("p.cls").alias("y"))
        used = staged(new if used is None else used.unionByName(new), "used-pivots")
        p = pivots.select("h", F.col("p.cls").alias("y"), F.struct("p.n", "p.pos").alias("b"), F.col("p.root").alias("yroot"))
        pairs = rows.select("h", F.col("cls").alias("x"), F.struct("n", "pos").alias("a"), "root").join(p, "h").where("x <> y and root <> yroot").where(_possible("a", "b", num, den)).select("x", "y").distinct()
        if known is not None:
            pairs = pairs.join(known.select("x", "y"), ["x", "y"], "left_anti")
        found = _compared(pairs, classes).withColumn("d", F.expr("1 - overlap / (nx + ny - overlap)")).withColumn("link", F.expr(_linked(num, den))).select("x", "y", "d", "link")
        known = staged(found if known is None else found.unionByName(known), "pivot-distances")
        root = staged(_rooted(known), "pivot-roots")

    # What no component holds together yet, region by region, within the windows.
    rows = prefix.join(root, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    span = rows.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.expr("max(struct(-(own / n) as c, cls as cls, root as root))").alias("p")).where("lo <> hi")
    open_ = rows.join(span.select("h", F.col("p.cls").alias("pivot"), F.col("p.root").alias("main")), "h")
    open_ = open_.join(known.select(F.col("x").alias("cls"), F.col("y").alias("pivot"), "d"), ["cls", "pivot"], "left").withColumn("d", F.when(F.col("cls") == F.col("pivot"), 0.0).otherwise(F.col("d")))
    open_ = staged(open_.select("h", "cls", "n", "pos", "root", "main", "d"), "open-regions")
    left, right = open_.where("root <> main").alias("a"), open_.alias("b")
    window = F.expr(f"(b.root = b.main or a.cls < b.cls) and a.root <> b.root and {_possible('a', 'b', num, den)} and coalesce(abs(a.d - b.d) <= {radius + 1e-9}d, true)")
    pairs = left.join(right, (F.col("a.h") == F.col("b.h")) & window).select(F.col("a.cls").alias("x"), F.col("b.cls").alias("y")).distinct()
    met = known.select("x", "y").unionByName(known.select(F.col("y").alias("x"), F.col("x").alias("y")))
    last = _compared(pairs.join(met, ["x", "y"], "left_anti"), classes).where(_linked(num, den)).select("x", "y")
    found = components(known.where("link").select("x", "y").unionByName(last).toDF("u", "v"))
    root = who.join(found.withColumnRenamed("node", "cls"), "cls", "left").select("k_id", "k_text", F.coalesce("root", "cls").alias("root"))
    return sized, root


def _rooted(known: DataFrame) -> DataFrame:
    return components(known.where("link").select(F.col("x").alias("u"), F.col("y").alias("v"))).withColumnRenamed("node", "cls")


def join(docs: DataFrame, *, n: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """A row per row of docs: k_id, k_text, doc_id, n_shingles, component_id (the smallest doc_id reachable by links), root (what names a component even without ids; null if no other document is near)."""
    sized, root = links(docs, n=n, num=num, den=den)
    real, root = key_id(), staged(root, "roots")
    # Written before it is joined: partial minima meet per component, and Spark can split the join where one holds many rows.
    least = staged(root.groupBy("root").agg(F.min(real).alias("least")), "component-least")
    named = staged(root.join(least, "root").select("k_id", "k_text", "least", "root"), "component-names")
    return sized.join(named, ["k_id", "k_text"], "left").select("k_id", "k_text", real.alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("least", real).alias("component_id"), "root")
