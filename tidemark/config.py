"""Configuration of a run: read from YAML or JSON (or a dict), filled in with defaults and checked before anything starts.

A section is a table of fields: kind, default and test. All that is wrong with a configuration is told at once.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any
from urllib.parse import parse_qs, urlsplit

from tidemark.functions.convert import CONVERTERS, FALSE_WORDS, TRUE_WORDS
from tidemark.operators.mapping import IDENTIFIER
from tidemark.operators.mapping import Mapping as Projection
from tidemark.operators.mapping import Rule

REQUIRED = object()
#: Identifiers by kind of source or target: a document's fields are any names, dots part their levels.
DIALECTS = {"relational": IDENTIFIER, "wide": re.compile(r"[A-Za-z][A-Za-z0-9_]{0,47}"), "document": re.compile(r"[^.\0]+(\.[^.\0]+)*", re.S)}


class ConfigError(ValueError):
    def __init__(self, faults: list[str]) -> None:
        super().__init__("; ".join(faults))
        self.faults = faults


def boolean(value: Any) -> bool:
    if isinstance(value, (bool, int, float)):
        return bool(value)
    word = str(value).strip().lower()
    if word not in (*TRUE_WORDS, *FALSE_WORDS):
        raise ValueError(f"not a boolean: {value!r}")
    return word in TRUE_WORDS


def texts(value: Any) -> list[str]:
    if not isinstance(value, list) or any(not isinstance(x, str) or not x for x in value):
        raise ValueError("not a list of texts")
    return list(value)


def name(value: Any) -> str:
    return str(value).lower()


@dataclass(frozen=True)
class Field:
    kind: Callable[[Any], Any]
    default: Any = REQUIRED
    test: Callable[[Any], bool] | None = None
    says: str = ""


def one_of(*words: str, default: Any = REQUIRED) -> Field:
    return Field(name, default, lambda v: v in words, f"must be one of {', '.join(words)}")


def at_least(low: float, default: Any, kind: Callable = int) -> Field:
    return Field(kind, default, lambda v: v >= low, f"must be at least {low}")


def above(low: float, default: Any, kind: Callable = int) -> Field:
    return Field(kind, default, lambda v: v > low, f"must be above {low}")


RUN = {
    "environment": one_of("dev", "stage", "prod", default="dev"),
    "mode": one_of("full", "incremental", default="full"),
    "error_mode": one_of("fail", "skip", default="fail"),
    "log_format": one_of("text", "json", default="text"),
    "log_level": Field(str, "INFO"),
    "metrics_format": one_of("text", "json", default="text"),
    "batch_size": above(0, 500),
    "page_size": above(0, 200),
    "dry_run": Field(boolean, False),
    "overlap_seconds": at_least(0, 5),
    "retry_attempts": at_least(1, 5),
    "retry_first_seconds": at_least(0, 0.5, float),
    "retry_most_seconds": at_least(0, 15.0, float),
    "retry_factor": at_least(1, 2.0, float),
    "retry_jitter_seconds": at_least(0, 0.25, float),
    "lease_seconds": above(0, 120),
    "heartbeat_seconds": above(0, 30),
    "leases": Field(str, ""),
    "progress": Field(str, ""),
    "run_id": Field(str, ""),
    "dead_letters": Field(str, "state/dead_letters"),
    "gate": Field(str, ""),
    "gate_scope": Field(str, ""),
    "gate_hours": above(0, 72),
    "require_gate": Field(boolean, False),
    "limits": Field(dict, {}),
}
ROUTING = {
    "document_below": above(0, 1_048_576),
    "relational_most": above(0, 8_388_608),
    "overhead": at_least(0, 2_048),
}
SHARDS = {
    "shards": above(0, 1),
    "shard_mode": one_of("none", "client_hash", "query_template", default="none"),
    "shard_key": Field(str, ""),
    "query": Field(str, ""),
    "incremental_query": Field(str, ""),
    "enabled": Field(boolean, True),
}
PROJECTION = SHARDS | {
    "source": Field(str),
    "target": Field(str, test=lambda v: bool(IDENTIFIER.fullmatch(v)), says="must be an identifier"),
    "keys": Field(texts, test=bool, says="must not be empty"),
    "columns": Field(list, test=bool, says="must not be empty"),
    "write": one_of("upsert", "insert", "update", "replace", default="upsert"),
    "statics": Field(dict, {}),
    "compare": Field(texts, []),
    "delete": Field(dict, {}),
}
JOB = SHARDS | {
    "name": Field(str),
    "api": one_of("document", "wide"),
    "namespace": Field(str),
    "keys": Field(texts, test=bool, says="must not be empty"),
    "incremental_field": Field(str, ""),
}
COLUMN = {
    "target": Field(str, test=lambda v: bool(IDENTIFIER.fullmatch(v)), says="must be an identifier"),
    "source": Field(str, None),
    "convert": Field(str, "identity", lambda v: v in CONVERTERS, f"must be one of {', '.join(CONVERTERS)}"),
    "required": Field(boolean, False),
    "default": Field(lambda v: v, None),
}


def section(raw: Any, fields: Mapping[str, Field], where: str, faults: list[str]) -> dict[str, Any]:
    """The section's values; what is wrong is added to faults."""
    if not isinstance(raw, dict):
        faults.append(f"{where}: not a section")
        return {}
    faults += [f"{where}.{k}: unknown" for k in raw if k not in fields]
    out = {}
    for key, f in fields.items():
        given = raw.get(key)
        if given is None or (given == "" and f.default is REQUIRED):
            if f.default is REQUIRED:
                faults.append(f"{where}.{key}: missing")
            else:
                out[key] = f.default
            continue
        try:
            out[key] = f.kind(given)
        except (TypeError, ValueError) as e:
            faults.append(f"{where}.{key}: {e}")
            continue
        if f.test and not f.test(out[key]):
            faults.append(f"{where}.{key}: {f.says}")
    return out


def _sharded(piece: dict[str, Any], where: str, faults: list[str]) -> None:
    mode, many = piece.get("shard_mode"), piece.get("shards", 1) > 1
    if many and mode == "none":
        faults.append(f"{where}: several shards need a shard_mode")
    if many and mode == "client_hash" and "target" in piece and not piece.get("shard_key"):
        faults.append(f"{where}.shard_key: missing")
    if many and mode == "query_template":
        for key in ("query", "incremental_query"):  # both, where given: one without marks would be read whole by every shard
            text = piece.get(key) or ""
            if (text or key == "query") and not ("{{SHARD_INDEX}}" in text or "{{SHARD_COUNT}}" in text):
                faults.append(f"{where}.{key}: has no shard marks")


def projection(raw: Any, where: str = "mapping", faults: list[str] | None = None) -> tuple[dict[str, Any], Projection | None]:
    """A mapping section: its settings and the compiled mapping (None where faults were found)."""
    found: list[str] = []
    out = section(raw, PROJECTION, where, found)
    columns = [section(c, COLUMN, f"{where}.columns[{i}]", found) for i, c in enumerate(out.get("columns", []))]
    made = [*[c.get("target") for c in columns], *out.get("statics", {})]
    found += [f"{where}.{k}: {c} isn't a column made" for k in ("keys", "compare") for c in out.get(k, []) if c not in made]
    if len(set(out.get("compare", []))) < len(out.get("compare", [])):
        found.append(f"{where}.compare: has a column twice")
    _sharded(out, where, found)
    delete = section(out.get("delete") or {"field": ""}, {"field": Field(str, ""), "equals": Field(lambda v: v, True)}, f"{where}.delete", found) if out.get("delete") else {}
    compiled = None
    if not found:
        given = [c for c in raw["columns"]]
        rules = tuple(Rule(c["target"], c["source"], c["convert"], c["required"], c["default"], "default" in g) for c, g in zip(columns, given))
        try:
            compiled = Projection(rules, tuple(out["keys"]), out["statics"], delete.get("field") or None, delete.get("equals", True))
        except ValueError as e:
            found.append(f"{where}: {e}")
    if faults is not None:
        faults += found
    elif found:
        raise ConfigError(found)
    return out, compiled


@dataclass(frozen=True)
class Config:
    run: dict[str, Any]
    routing: dict[str, Any]
    mappings: list[tuple[dict[str, Any], Projection]]
    jobs: list[dict[str, Any]]

    def selected(self, *names: str) -> list[dict[str, Any]]:
        """Enabled jobs and mappings, those named if any are; a name that is nothing enabled is an error."""
        pieces = [p for p in [*self.jobs, *[m for m, _ in self.mappings]] if p["enabled"]]
        known = {p.get("name") or p["source"] for p in pieces}
        if lost := [n for n in names if n not in known]:
            raise ConfigError([f"nothing enabled is named {n}" for n in lost])
        return [p for p in pieces if not names or (p.get("name") or p["source"]) in names]

    def fingerprint(self) -> str:
        from tidemark.operators.control import workload_fingerprint

        pieces = [*self.jobs, *[m for m, _ in self.mappings]]
        return workload_fingerprint("v2" if self.jobs else "v1", pieces, self.routing | {k: self.run[k] for k in ("overlap_seconds", "batch_size", "page_size")})


def parsed(raw: Any) -> Config:
    """A configuration, or a ConfigError that names all faults."""
    faults: list[str] = []
    raw = raw if isinstance(raw, dict) else {}
    faults += [f"{k}: unknown" for k in raw if k not in ("run", "routing", "mappings", "jobs")]
    run = section(raw.get("run") or {}, RUN, "run", faults)
    routing = section(raw.get("routing") or {}, ROUTING, "routing", faults)
    if routing.get("relational_most", 0) < routing.get("document_below", 0):
        faults.append("routing.relational_most: must not be below document_below")
    if run.get("leases") and run.get("heartbeat_seconds", 0) >= run.get("lease_seconds", 1):
        faults.append("run.heartbeat_seconds: must be below lease_seconds")
    for key, other in (("progress", "run_id"), ("gate", "gate_scope")):
        if run.get(key) and not run.get(other):
            faults.append(f"run.{other}: missing, as {key} is set")
    if run.get("require_gate") and (run.get("environment") != "prod" or not run.get("gate")):
        faults.append("run.require_gate: needs environment prod and a gate")
    run["limits"] = {str(k): int(v) if v is not None and int(v) > 0 else None for k, v in run.get("limits", {}).items()}
    mappings = [projection(m, f"mappings[{i}]", faults) for i, m in enumerate(raw.get("mappings") or [])]
    jobs = [section(j, JOB, f"jobs[{i}]", faults) for i, j in enumerate(raw.get("jobs") or [])]
    for i, j in enumerate(jobs):
        _sharded(j, f"jobs[{i}]", faults)
        pattern = DIALECTS.get(j.get("api"))
        faults += [f"jobs[{i}]: {n!r} isn't a name of a {j['api']} source" for n in (*j.get("keys", []), j.get("incremental_field")) if pattern and n and not pattern.fullmatch(n)]
    names = [j.get("name") for j in jobs]
    faults += [f"jobs: {n} is there twice" for n in sorted({n for n in names if n and names.count(n) > 1})]
    if not mappings and not jobs:
        faults.append("neither mappings nor jobs")
    if faults:
        raise ConfigError(faults)
    return Config(run, routing, mappings, jobs)


def load(path: str) -> Config:
    """From a YAML or JSON file; ${NAME} in a text stands for an environment variable, which must be set."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith((".yaml", ".yml")):
        import yaml

        raw = yaml.safe_load(text)
    else:
        raw = json.loads(text)
    return parsed(_filled(raw))


def _filled(raw: Any) -> Any:
    if isinstance(raw, dict):
        return {k: _filled(v) for k, v in raw.items()}
    if isinstance(raw, list):
        return [_filled(v) for v in raw]
    if isinstance(raw, str):
        missing = [n for n in re.findall(r"\$\{(\w+)\}", raw) if n not in os.environ]
        if missing:
            raise ConfigError([f"environment variable {n} isn't set" for n in missing])
        return re.sub(r"\$\{(\w+)\}", lambda m: os.environ[m[1]], raw)
    return raw


@dataclass(frozen=True)
class ControlTable:
    scheme: str
    project: str
    instance: str
    database: str
    table: str
    namespace: str


def control_table(uri: str, scheme: str = "table") -> ControlTable:
    """scheme://project/instance/database/table?namespace=name."""
    parts = urlsplit(uri)
    path = [p for p in parts.path.split("/") if p]
    namespace = parse_qs(parts.query).get("namespace", [""])[0].strip()
    if parts.scheme != scheme or not parts.netloc or len(path) != 3 or not namespace or not IDENTIFIER.fullmatch(path[2]):
        raise ValueError(f"not a control table: {uri!r}")
    return ControlTable(scheme, parts.netloc, *path, namespace)


def object_place(uri: str) -> tuple[str, str, str]:
    """scheme://bucket/key, apart."""
    scheme, _, rest = uri.partition("://")
    bucket, _, key = rest.partition("/")
    if not scheme or not bucket or not key:
        raise ValueError(f"not an object's place: {uri!r}")
    return scheme, bucket, key
