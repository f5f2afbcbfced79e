"""Paths into semi-structured documents and the closed set of converters, as column expressions.

A document is a VARIANT, which tells a missing path from a JSON null. A conversion gives a value or, where the
reference semantics call for an error, marks the row through its error text; no row fails a job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of the boolean converter.
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")
ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def _quoted(part: str) -> str:
    return "['" + part.replace("'", "\\'") + "']"


def path_options(path: str) -> list[str]:
    """JSON paths a dotted path may mean: a number is an object's key first, else a list's place."""
    out = ["$"]
    for part in path.split("."):
        out = [o + s for o in out for s in ([_quoted(part), f"[{part}]"] if part.isdigit() else [_quoted(part)])]
    return out


def at_path(doc: Column, path: str) -> Column:
    """The VARIANT at the path; null where the path is missing (a JSON null stays a variant)."""
    return F.coalesce(*[F.try_variant_get(doc, p, "variant") for p in path_options(path)])


def _text(v: Column) -> Column:
    s = F.try_variant_get(v, "$", "string")
    return F.when(F.schema_of_variant(v) == "BOOLEAN", F.initcap(s)).otherwise(s)


def _int(v: Column) -> Column:
    kind, s = F.schema_of_variant(v), F.try_variant_get(v, "$", "string")
    text = F.when(F.trim(s).rlike(r"^[+-]?\d+$"), F.trim(s).try_cast("long"))
    return F.when(kind == "STRING", text).when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("long")).otherwise(F.try_variant_get(v, "$", "bigint"))


def _float(v: Column) -> Column:
    kind, s = F.schema_of_variant(v), F.try_variant_get(v, "$", "string")
    return F.when(kind == "STRING", F.trim(s).try_cast("double")).when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double")).otherwise(F.try_variant_get(v, "$", "double"))


def bool_of_text(s: Column) -> Column:
    w = F.lower(F.trim(s))
    return F.when(w.isin(*TRUE_WORDS), True).when(w.isin(*FALSE_WORDS), False)


def _bool(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    number = F.try_variant_get(v, "$", "double")
    return F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean")).when(kind == "STRING", bool_of_text(F.try_variant_get(v, "$", "string"))).when(number.isNotNull(), number != 0)


def timestamp_of_text(s: Column) -> Column:
    """ISO text as a UTC time; what isn't ISO is null."""
    t = F.regexp_replace(F.trim(s), "T", " ")
    return F.when(F.trim(s).rlike(ISO), F.try_to_timestamp(t))


def _timestamp(v: Column) -> Column:
    kind, number = F.schema_of_variant(v), F.try_variant_get(v, "$", "double")
    return F.when(kind == "STRING", timestamp_of_text(F.try_variant_get(v, "$", "string"))).when(number.isNotNull() & (kind != "BOOLEAN"), F.timestamp_micros((number * 1000000).cast("long")))


def _json(v: Column) -> Column:
    return F.to_json(v)


CONVERTERS: dict[str, Callable[[Column], Column]] = {
    "identity": lambda v: v,
    "string": _text,
    "int": _int,
    "float": _float,
    "bool": _bool,
    "timestamp": _timestamp,
    "datetime": _timestamp,
    "json_string": _json,
}


def register(name: str, convert: Callable[[Column], Column]) -> None:
    """Add a converter from VARIANT column to column; an existing name isn't replaced."""
    if name in CONVERTERS:
        raise ValueError(f"converter {name} exists")
    CONVERTERS[name] = convert
