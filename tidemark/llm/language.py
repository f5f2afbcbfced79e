"""Operator 4: language proportions by expectation-maximisation over n-gram likelihoods.

Learning counts hashed letter trigrams per language over every labelled row (partial sums in each task, so the rows
of a language never meet in one task); the model is a table of languages x buckets. A document is then taken for a
mixture: expectation-maximisation estimates the proportions of all languages from its trigrams' likelihoods. Sets of
its most proportionate languages, one, two, and so on, are fitted the same way and the set with the best penalised
likelihood is kept. The whole text counts, upper and lower case alike; only letters and the gaps between them do.

Nulls: a null text, or one without a letter, is `und` with score 0, as is everything if nothing was learned. Rows with
a null lang teach nothing. Repeated rows count and are predicted again each. Of languages with equal proportions the
first by name is taken. A long text is counted whole, in an array of fixed size. An empty table gives an empty one. The
model (BUCKETS numbers for each language) is broadcast: the languages are counted first, more than MOST raise an error.
Other columns are not looked at; those asked for by `keep` come along, with _ after a name that a result has.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import claim_cache, tidied, unused

#: Trigram buckets, and the languages a model may have (it then takes 200 MB).
BUCKETS, MOST = 1 << 16, 400
_letters: list[np.ndarray] = []


def _folded() -> np.ndarray:
    """Code point -> its small letter, 0 for what isn't a letter."""
    if not _letters:
        fold = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            if unicodedata.category(c := chr(i))[0] == "L":
                fold[i] = ord(c.lower()[0])
        _letters.append(fold)
    return _letters[0]


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of the text's trigrams and their counts; none if it has no letter."""
    codes = _folded()[np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not codes.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gap = codes == 0
    codes = np.concatenate(([0], codes[~(gap & np.concatenate(([True], gap[:-1])))], [0])).astype(np.uint64)
    h = codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + codes[2:] * np.uint64(0x165667B19E3779F9)
    counts = np.bincount(((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64), minlength=BUCKETS)
    found = np.nonzero(counts)[0]
    return found, counts[found]


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray) -> None:
        """counts: languages x buckets."""
        self.langs = langs
        total = counts.sum(1, keepdims=True)
        self.likelihood = ((counts + 0.25) / (total + 0.25 * BUCKETS)).astype(np.float64)

    def mixture(self, like: np.ndarray, n: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
        """Proportions of the columns of like, and the logarithm of the likelihood under them."""
        share = np.full(like.shape[1], 1 / like.shape[1])
        whole = n.sum()
        for _ in range(rounds if len(share) > 1 else 0):
            mixed = like * share
            share = (n / mixed.sum(1)) @ mixed / whole
        return share, float(n @ np.log(like @ share))

    def predict(self, text: str | None, rounds: int = 20, penalty: float = 6.0) -> tuple[str, float, list[tuple[str, float]]]:
        """Language, its proportion times how much likelier it makes the text than the next language does, and all languages kept."""
        at, n = trigrams(text)
        if not len(at) or not self.langs:
            return "und", 0.0, []
        like = self.likelihood[:, at].T
        share, best = self.mixture(like, n, rounds)
        order = np.argsort(-share, kind="stable")
        cost = penalty * np.log(n.sum() + 1)
        kept, shares, value = order[:1], np.ones(1), -np.inf
        for k in range(1, len(order) + 1):
            # No set does better than all languages together, so larger sets can't win once their penalty outweighs that.
            if best - cost * k <= value:
                break
            s, found = self.mixture(like[:, order[:k]], n, rounds)
            if found - cost * k > value:
                kept, shares, value = order[:k], s, found - cost * k
        single = n @ np.log(like)
        top = int(kept[int(np.argmax(shares))])
        rest = np.delete(single, top)
        sure = 1 / (1 + float(np.exp(np.clip((rest - single[top]) / 3, -700, 30)).sum())) if len(kept) == 1 else 1.0
        score = float(min(1.0, max(0.0, shares.max() * sure)))
        return self.langs[top], score, sorted(((self.langs[int(i)], float(s)) for i, s in zip(kept, shares)), key=lambda x: -x[1])


def learn(rows: DataFrame) -> Model:
    """rows: text, lang. The result's size is languages x BUCKETS counts."""

    def count(batches):
        claim_cache("language model", lambda: None)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                for t, lang in zip(*(batch.column(i).slice(a, 512).to_pylist() for i in (0, 1)), strict=True):
                    at, n = trigrams(t)
                    sums.setdefault(lang, np.zeros(BUCKETS, np.int64))[at] += n
        for lang, c in sums.items():
            at = np.nonzero(c)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at])], names=["lang", "bucket", "n"])

    rows = rows.where("lang is not null")
    if rows.select("lang").distinct().limit(MOST + 1).count() > MOST:
        raise ValueError(f"lang has more than {MOST} values: a column of languages is wanted")
    got = rows.select("text", "lang").mapInArrow(tidied(count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(got["lang"].to_pylist()))
    counts = np.zeros((len(langs), BUCKETS), np.int64)
    place = {x: i for i, x in enumerate(langs)}
    counts[[place[x] for x in got["lang"].to_pylist()], got["bucket"].to_numpy()] = got["n"].to_numpy()
    return Model(langs, counts)


def held_out() -> F.Column:
    """Documents that teach nothing: crc32 of the doc_id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, *, keep: list[str] | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages ("de:0.83,en:0.17"), and the columns named in keep."""
    spark = docs.sparkSession
    model = learn(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    shared = spark.sparkContext.broadcast(model)
    results = ["doc_id", "held_out", "lang_pred", "score", "languages"]
    kept = unused([*results, "_text"], *(keep or []))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("_text"), *[F.col(f"`{c}`").alias(k) for c, k in zip(keep or [], kept)])
    names = ["doc_id", "held_out", *kept]

    def run(batches):
        claim_cache("language model", lambda: None)
        m = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                got = [m.predict(t) for t in batch.column("_text").to_pylist()]
                mixed = [",".join(f"{x}:{s:.3f}" for x, s in g[2]) for g in got]
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array(mixed, pa.string())], names=[*names, "lang_pred", "score", "languages"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(tidied(run), ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", lang_pred string, score double, languages string")
