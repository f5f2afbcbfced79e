"""Document mappings compiled to one projection: columns, statics, keys, delete rule, watermark and row errors."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.convert import CONVERTERS, at_path
from tidemark.operators import merge

#: Fixed value: static columns with this text hold the time of the run.
NOW = "__NOW_UTC__"
IDENTIFIER = re.compile(r"^[A-Za-z][A-Za-z0-9_]*$")


@dataclass(frozen=True)
class Rule:
    """target <- source path. A default stands in for a missing path only, unconverted; a JSON null stays null."""

    target: str
    source: str | None = None
    convert: str = "identity"
    required: bool = False
    default: Any = None
    has_default: bool = False


@dataclass(frozen=True)
class Mapping:
    rules: tuple[Rule, ...]
    keys: tuple[str, ...]
    statics: dict[str, Any] = field(default_factory=dict)
    delete_path: str | None = None
    delete_value: Any = True
    watermark: str = "_ts"

    def __post_init__(self) -> None:
        targets = [r.target for r in self.rules]
        if len(set(targets)) < len(targets):
            raise ValueError("two rules have one target")
        for n in [*targets, *self.statics, *self.keys]:
            if not IDENTIFIER.match(n):
                raise ValueError(f"not an identifier: {n!r}")
        if not self.keys or set(self.keys) - {*targets, *self.statics}:
            raise ValueError("keys must be among the columns made")
        if bad := [r.convert for r in self.rules if r.convert not in CONVERTERS]:
            raise ValueError(f"unknown converters: {bad}")

    def compared(self, columns: tuple[str, ...] = ()) -> list[str]:
        """Columns that comparisons look at: the keys, then those asked for or all that rules make, and statics; none that differ from run to run."""
        made = dict.fromkeys([*self.keys, *(columns or [r.target for r in self.rules]), *self.statics])
        return [c for c in made if c not in self.volatile()]

    def volatile(self) -> set[str]:
        """Columns that differ from run to run; comparisons leave them out."""
        return {n for n, v in self.statics.items() if v == NOW} | {r.target for r in self.rules if r.has_default and r.default == NOW}


def _equals(v: Column, literal: Any) -> Column:
    """Equality in which true is 1; a missing path equals nothing."""
    if literal is None:
        return F.is_variant_null(v)
    if isinstance(literal, bool) or isinstance(literal, (int, float)):
        flag = F.try_variant_get(v, "$", "boolean").cast("double")
        number = F.when(F.schema_of_variant(v) == "STRING", None).when(F.schema_of_variant(v) == "BOOLEAN", flag).otherwise(F.try_variant_get(v, "$", "double"))
        return number == float(literal)
    return (F.schema_of_variant(v) == "STRING") & (F.try_variant_get(v, "$", "string") == literal)


def _defaulted(r: Rule, missing: Column, value: Column) -> tuple[Column, Column]:
    """The value, or the default in its type where the path is missing; the marker stands for the time of the run. And the error where the default has no such form."""
    literal = F.current_timestamp() if r.default == NOW else F.lit(r.default)
    if r.convert == "identity":
        return F.when(missing, F.lit(None) if r.default is None else literal.cast("variant")).otherwise(value), F.lit(None).cast("string")
    kind = KINDS.get(r.convert, "string")
    typed = literal.cast("string") if kind == "string" else literal.cast("string").try_cast(kind)
    wrong = F.when(missing & typed.isNull(), F.lit(f"{r.target}: default isn't {r.convert}")) if r.default is not None else F.lit(None).cast("string")
    return F.when(missing, typed).otherwise(value), wrong


#: Types of what the converters give, where it isn't text.
KINDS = {"int": "bigint", "float": "double", "bool": "boolean", "timestamp": "timestamp", "datetime": "timestamp"}


def project(docs: DataFrame, mapping: Mapping, doc: str = "doc", keep: tuple[str, ...] = ()) -> DataFrame:
    """keep columns, the mapping's columns, is_delete, source_ts and error (null: the row is good)."""
    d = F.col(doc)
    made: dict[str, Column] = {}
    errors: list[Column] = []
    for r in mapping.rules:
        if r.source is None:
            made[r.target] = F.lit(None).cast("string")
            continue
        v = at_path(d, r.source)
        missing, null = v.isNull(), F.is_variant_null(v)
        value = F.when(~null, CONVERTERS[r.convert](v)) if r.convert != "identity" else v
        if r.convert not in ("identity", "json_string"):
            errors.append(F.when(~missing & ~null & value.isNull(), F.lit(f"{r.target}: not {r.convert}")))
        if r.has_default:
            value, wrong = _defaulted(r, missing, value)
            errors.append(wrong)
        elif r.required:
            errors.append(F.when(missing, F.lit(f"{r.target}: missing {r.source}")))
        made[r.target] = value
    for name, v in mapping.statics.items():
        made[name] = F.current_timestamp() if v == NOW else F.lit(v)
    errors += [F.when(made[k].isNull(), F.lit(f"{k}: key is null")) for k in mapping.keys]
    deleted = F.coalesce(_equals(at_path(d, mapping.delete_path), mapping.delete_value), F.lit(False)) if mapping.delete_path else F.lit(False)
    mark = at_path(d, mapping.watermark)
    ts = F.coalesce(CONVERTERS["int"](mark), F.lit(0).cast("long"))
    blank = F.is_variant_null(mark) | (F.try_variant_get(mark, "$", "string") == "") | (F.schema_of_variant(mark) == "ARRAY<VOID>") | (F.schema_of_variant(mark) == "OBJECT<>")
    errors.append(F.when(mark.isNotNull() & ~blank & CONVERTERS["int"](mark).isNull(), F.lit(f"{mapping.watermark}: not int")))
    error = F.coalesce(F.when(d.isNull(), F.lit("not a JSON document")), *errors) if errors else F.when(d.isNull(), F.lit("not a JSON document"))
    return docs.select(*keep, *[c.alias(n) for n, c in made.items()], deleted.alias("is_delete"), ts.alias("source_ts"), error.alias("error"))


def disposed(rows: DataFrame) -> DataFrame:
    """Adds disposition: failed, delete or upsert. Tombstones are transformed first, so a bad one fails."""
    return rows.withColumn("disposition", F.when(F.col("error").isNotNull(), "failed").when(F.col("is_delete"), "delete").otherwise("upsert"))


def latest(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key by the order columns: decides between upserts and deletes of one key in a run."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(o) for o in order])
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dead_letters(rows: DataFrame, job: str, raw: Column) -> DataFrame:
    """Failed rows as dead letters; every type is written."""
    return rows.where("error is not null").select(F.lit(job).alias("job"), raw.alias("payload"), F.col("error").alias("reason"), "source_ts")


def write_batch(target: DataFrame, rows: DataFrame, mapping: Mapping, job: str, raw: Column, mode: str = "upsert") -> tuple[DataFrame, DataFrame]:
    """(the table after a run's rows, its dead letters). rows: what project() gave.

    Failed rows become dead letters and nothing else is held up by them; of the others the last of each key decides
    between write and delete. What the mode forbids (an insert of a key that is there, an update of one that isn't) is a
    dead letter too.
    """
    keys = list(mapping.keys)
    made = [*dict.fromkeys([*[r.target for r in mapping.rules], *mapping.statics])]
    letters = dead_letters(rows, job, raw)
    last = latest(disposed(rows).where("disposition <> 'failed'").withColumn("_raw", raw), keys, "source_ts", "_raw")
    up, gone = last.where("disposition = 'upsert'"), last.where("disposition = 'delete'").select(*keys)
    forbidden = None
    if mode == "insert":
        out, forbidden = merge.insert(target, up.select(*made), keys)
    elif mode == "update":
        out, forbidden = merge.update(target, up.select(*made), keys)
    else:
        out = (merge.replace if mode == "replace" else merge.upsert)(target, up.select(*made), keys)
    if forbidden is not None:
        reason = F.lit("key exists" if mode == "insert" else "key doesn't exist")
        bad = up.join(forbidden.select(*keys), keys, "left_semi")
        letters = letters.unionByName(bad.select(F.lit(job).alias("job"), F.col("_raw").alias("payload"), reason.alias("reason"), "source_ts"))
    return merge.delete(out, gone, keys), letters
