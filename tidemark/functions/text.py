"""Canonical JSON, digests, keys and shards as column expressions (no Python runs on executors)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(doc: Column) -> Column:
    """Compact JSON with sorted keys of a JSON text; null where the text isn't JSON."""
    return F.to_json(F.try_parse_json(doc))


def json_bytes(doc: Column) -> Column:
    return F.octet_length(doc).cast("long")


def checksum(doc: Column) -> Column:
    return F.sha2(doc, 256)


def iso_utc(ts: Column) -> Column:
    """ISO text with microseconds and +00:00, alike for zoned and unzoned times (unzoned ones are UTC)."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def encoded(name: str, kind: str) -> Column:
    """A column as the digest sees it: times as ISO text, decimals as text, bytes as base64."""
    c = F.col(name)
    if kind.startswith("timestamp"):
        return iso_utc(c)
    if kind.startswith("decimal") or kind == "date":
        return c.cast("string")
    if kind == "binary":
        return F.when(c.isNotNull(), F.struct(F.base64(c).alias("__base64__")))
    return c


def row_json(dtypes: list[tuple[str, str]]) -> Column:
    """JSON of the columns by name, nulls kept."""
    return F.to_json(F.struct(*[encoded(n, k).alias(n) for n, k in sorted(dtypes)]), {"ignoreNullFields": "false"})


def row_digest(dtypes: list[tuple[str, str]]) -> Column:
    return F.sha2(row_json(dtypes), 256)


def key_text(dtypes: list[tuple[str, str]]) -> Column:
    """JSON array of the key columns, in the order given."""
    one = [F.to_json(F.struct(encoded(n, k).alias("k")), {"ignoreNullFields": "false"}) for n, k in dtypes]
    cut = [F.substring(p, F.lit(6), F.length(p) - 6) for p in one]  # what stands between {"k": and }
    return F.concat(F.lit("["), F.concat_ws(",", *cut), F.lit("]"))


def source_key(*cols: Column) -> Column:
    """Key parts as text joined by |; nulls read None. Parts that hold | can collide, see `ambiguous_key`."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("None")) for c in cols])


def ambiguous_key(*cols: Column) -> Column:
    """Whether a part of a composite key holds the separator."""
    found = F.lit(False)
    for c in cols if len(cols) > 1 else ():
        found = found | F.coalesce(F.contains(c.cast("string"), F.lit("|")), F.lit(False))
    return found


def route_key(namespace: Column, key: Column) -> Column:
    return F.concat(namespace, F.lit("|"), key)


def document_id(key: Column) -> Column:
    """The id of a record in the document sink: the digest of its route key."""
    return F.sha2(key, 256)


def normalised(c: Column, kind: str) -> Column:
    """A value as comparisons see it: times in UTC ISO text, JSON text with sorted keys, others as they are."""
    if kind.startswith("timestamp"):
        return iso_utc(c)
    return F.coalesce(canonical_json(c), c) if kind == "json" else c


def stable_shard(text: Column, shards: int) -> Column:
    """sha256(text) as a number, modulo shards: digit groups folded one after the other, so that no step exceeds 64 bits and all is one expression without a loop."""
    if shards <= 0:
        raise ValueError("shards must be above 0")
    h = F.sha2(text.cast("string"), 256)
    out = F.lit(0).cast("long")
    for i in range(0, 64, 8):  # (2**32 * shards stays below 2**63 for any count under 2**31)
        out = (out * (1 << 32) + F.conv(F.substring(h, i + 1, 8), 16, 10).cast("long")) % shards
    return out
