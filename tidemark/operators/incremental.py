"""Watermarks, checkpoints and order-dependent checks of incremental loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def after(df: DataFrame, col: str, watermark: int, overlap: int) -> DataFrame:
    """Strictly above the watermark moved back by the overlap; repeats are for upserts to absorb."""
    return df.where(F.col(col) > F.lit(max(0, watermark - overlap)))


def resume(df: DataFrame, col: str, at: Column, key: str, seen: DataFrame) -> DataFrame:
    """From the watermark on, without the keys already seen at it."""
    open_ = df.where(F.col(col) >= at)
    done = seen.select(F.col(key).alias("_k"))
    return open_.join(done, (F.col(key) == F.col("_k")) & (F.col(col) == at), "left_anti")


def checkpoint(df: DataFrame, col: str, key: str) -> DataFrame:
    """watermark: the largest; keys: those at it, sorted, as text joined by commas (`checkpoint_rows` keeps them as rows)."""
    top = df.agg(F.max(col).alias("watermark"))
    at = df.join(F.broadcast(top), F.col(col) == F.col("watermark"))  # one row
    return at.groupBy("watermark").agg(F.array_join(F.array_sort(F.collect_set(F.col(key).cast("string"))), ",").alias("keys"), F.count_distinct(key).alias("n_keys"))


def checkpoint_rows(df: DataFrame, by: list[str], col: str, key: str) -> DataFrame:
    """A checkpoint as rows, by, watermark, key: one for each key at its group's largest watermark, however many they are."""
    top = df.groupBy(*by).agg(F.max(col).alias("watermark"))
    return df.join(top, by).where(F.col(col) == F.col("watermark")).select(*by, "watermark", F.col(key).cast("string").alias("key")).distinct()


def compare(a: Column, b: Column) -> Column:
    """-1, 0 or 1; null is lowest. Both of one type: mixed ones are rejected when the plan is made, not compared as text."""
    return F.when(a.eqNullSafe(b), 0).when(a.isNull() | (a < b), -1).otherwise(1)


def compare_whole(a: Column, b: Column) -> Column:
    """The same for whole numbers given as any text or number: what isn't one counts as absent."""
    return compare(F.coalesce(a.try_cast("long"), F.lit(-1).cast("long")), F.coalesce(b.try_cast("long"), F.lit(-1).cast("long")))


def advanced(rows: DataFrame, stored: DataFrame, by: list[str], arrival: str, col: str, key: str, ok: Column) -> DataFrame:
    """The checkpoint after a run of each group (a shard of a job): stored or moved on.

    rows in order of arrival; stored: by, watermark, keys (array). Rows that the checkpoint contains are skipped. One that
    failed, or that came after a higher watermark, holds its own group's checkpoint and nobody else's; late rows are
    processed all the same. Else the checkpoint moves to the highest watermark and the keys at it, those stored at an
    equal one included. Gives by, watermark, keys, blocked, n_skipped, n_failed, n_late.
    """
    met = rows.join(stored.select(*by, F.col("watermark").alias("_at"), F.col("keys").alias("_keys")), by, "left")
    wm = F.col(col)
    met = met.withColumn("_seen", F.coalesce((wm < F.col("_at")) | ((wm == F.col("_at")) & F.array_contains("_keys", F.col(key))), F.lit(False)))
    before = Window.partitionBy(*by).orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    top = F.greatest(F.col("_at"), F.max(F.when(~F.col("_seen"), wm)).over(before))
    met = met.withColumns({"_late": ~F.col("_seen") & top.isNotNull() & (wm.isNull() | (wm < top)), "_ok": F.coalesce(ok, F.lit(False))})
    good = ~F.col("_seen") & F.col("_ok")
    sums = met.groupBy(*by).agg(
        F.max("_at").alias("_at"),
        F.max("_keys").alias("_keys"),
        F.max(F.when(good, wm)).alias("_top"),
        F.count_if("_seen").alias("n_skipped"),
        F.count_if(~F.col("_seen") & ~F.col("_ok")).alias("n_failed"),
        F.count_if("_late").alias("n_late"),
    )
    at_top = met.where(good).join(sums.select(*by, "_top"), by).where(wm == F.col("_top")).groupBy(*by).agg(F.collect_set(F.col(key)).alias("_new"))
    out = sums.join(at_top, by, "left").withColumn("blocked", (F.col("n_failed") > 0) | (F.col("n_late") > 0))
    moves = ~F.col("blocked") & F.col("_top").isNotNull() & (F.col("_at").isNull() | (F.col("_top") >= F.col("_at")))
    keys = F.when(F.col("_top") == F.col("_at"), F.array_union("_keys", "_new")).otherwise(F.col("_new"))
    return out.select(*by, F.when(moves, F.col("_top")).otherwise(F.col("_at")).alias("watermark"), F.array_sort(F.when(moves, keys).otherwise(F.col("_keys"))).alias("keys"), "blocked", "n_skipped", "n_failed", "n_late")


def merge_state(old: DataFrame, new: DataFrame, policy: str, **columns: str) -> DataFrame:
    """Two states of a store as one: policy is max (the larger watermark), ties (and the keys of equal ones) or last (written last; columns value and at)."""
    if policy == "max":
        return merge_max(old, new)
    if policy == "ties":
        return merge_ties(old, new)
    if policy == "last":
        return merge_last(old, new, columns["value"], columns["at"])
    raise ValueError(f"no merge policy {policy}")


def held(df: DataFrame, by: list[str], col: str, failed: Column, old: Column) -> DataFrame:
    """Per group: the watermark after a run, which moves only if nothing failed, and how far it lags."""
    ok = F.max(F.when(~failed, F.col(col)))
    out = df.groupBy(*by).agg(F.count_if(failed).alias("failures"), F.max(col).alias("max_seen"), ok.alias("max_success"))
    return out.withColumn("watermark", F.when(F.col("failures") == 0, F.greatest(old, F.col("max_success"))).otherwise(old)).withColumn("lag", F.greatest(F.lit(0).cast("long"), F.col("max_seen") - F.coalesce("max_success", F.lit(0).cast("long"))))


def _running(df: DataFrame, by: list[str], arrival: str, value: Column, ranges: int) -> DataFrame:
    """Adds _top: the largest value that arrived before, in the group. Two passes: inside ranges of arrival, whose maxima are then met in order, so that a group of any size is dealt over `ranges` tasks.

    Ranges are prefixes of a hash-like arrival text, or equal widths of a numeric or time one; either way they follow from the value alone.
    """
    kind = dict(df.dtypes)[arrival]
    if kind == "string":
        # Texts that begin alike share a range; texts compare as their beginnings do.
        part = F.left(F.col(arrival), F.lit(2))
    else:
        number = F.unix_micros(F.col(arrival).cast("timestamp")) if kind in ("date", "timestamp", "timestamp_ntz") else F.col(arrival)
        lo, hi = df.agg(F.min(number), F.max(number)).first()
        part = F.floor((number - F.lit(lo or 0)) * ranges / F.lit(((hi or 0) - (lo or 0)) + 1))
    rows = df.withColumns({"_range": part, "_value": value})
    inside = Window.partitionBy(*by, "_range").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    tops = rows.groupBy(*by, "_range").agg(F.max("_value").alias("_max")).withColumn("_before", F.max("_max").over(across))
    met = rows.withColumn("_inside", F.max("_value").over(inside)).join(tops.select(*by, "_range", "_before"), [*by, "_range"])
    return met.withColumn("_top", F.greatest("_inside", "_before")).drop("_range", "_value", "_inside", "_before")


def disorder(df: DataFrame, by: list[str], arrival: str, col: str, seed: int, *, ranges: int = 256) -> DataFrame:
    """late: the watermark lies below one that came before (or below the seed). Late rows are flagged, never dropped."""
    return _running(df, by, arrival, F.col(col), ranges).withColumn("late", F.col(col) < F.greatest(F.lit(seed).cast("long"), F.col("_top"))).drop("_top")


def rising(df: DataFrame, by: list[str], arrival: str, col: str, key: str, *, ranges: int = 256) -> DataFrame:
    """Rows whose (watermark, key) exceeds all before them in their group: a reader that never steps back."""
    me = F.struct(F.col(col), F.col(key))
    return _running(df, by, arrival, me, ranges).where(F.col("_top").isNull() | (me > F.col("_top"))).drop("_top")


def positions(df: DataFrame, by: list[str], pos: str, failed: Column) -> DataFrame:
    """last_success: the last good position even past failures; resume_at: the last one before the first failure."""
    first = df.where(failed).groupBy(*by).agg(F.min(pos).alias("_f"))
    rows = df.join(first, by, "left")
    return rows.groupBy(*by).agg(F.max(F.when(~failed, F.col(pos))).alias("last_success"), F.max(F.when(F.col("_f").isNull() | (F.col(pos) < F.col("_f")), F.col(pos))).alias("resume_at"))


def with_fallback(jobs: DataFrame, store: DataFrame) -> DataFrame:
    """jobs: job, scoped, plain. The watermark under the scoped name, else under the plain one, else 0."""
    a, b = store.select(F.col("key").alias("scoped"), F.col("watermark").alias("w1")), store.select(F.col("key").alias("plain"), F.col("watermark").alias("w2"))
    return jobs.join(a, "scoped", "left").join(b, "plain", "left").select("job", F.coalesce("w1", "w2", F.lit(0).cast("long")).alias("watermark"), F.when(F.col("w1").isNotNull(), "scoped").when(F.col("w2").isNotNull(), "plain").otherwise("none").alias("origin"))


def merge_max(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per key the larger watermark."""
    return old.unionByName(new).groupBy("key").agg(F.max("watermark").alias("watermark"))


def merge_ties(old: DataFrame, new: DataFrame) -> DataFrame:
    """key, watermark, keys (array): the larger watermark wins, equal ones join their keys."""
    both = old.unionByName(new)
    top = both.groupBy("key").agg(F.max("watermark").alias("watermark"))
    return both.join(top, ["key", "watermark"]).groupBy("key", "watermark").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("keys")))).alias("keys"))


def merge_last(old: DataFrame, new: DataFrame, value: str, at: str) -> DataFrame:
    """Per key the value written last; a tie goes to the new side."""
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    order = F.struct(at, "_side")
    return both.groupBy("key").agg(F.max_by(value, order).alias(value), F.max_by(at, order).alias(at))
