"""Configurations: defaults, every check, and places."""

import json

import pytest

from tidemark import config


def mapping(**more):
    return {"source": "trips", "target": "Trips", "keys": ["Id"], "columns": [{"target": "Id", "source": "id", "convert": "int", "required": "yes"}, {"target": "Note", "source": "n", "default": None}]} | more


def faults(raw):
    with pytest.raises(config.ConfigError) as e:
        config.parsed(raw)
    return e.value.faults


def test_defaults():
    c = config.parsed({"run": {"dry_run": "Y", "limits": {"trips": "0", "b": 5}}, "mappings": [mapping(delete={"field": "gone"})], "jobs": [{"name": "j", "api": "Wide", "namespace": "n", "keys": ["k"], "enabled": "no"}]})
    assert c.run["dry_run"] is True and c.run["limits"] == {"trips": None, "b": 5} and c.routing["document_below"] == 1048576
    settings, projection = c.mappings[0]
    assert settings["write"] == "upsert" and projection.keys == ("Id",) and projection.rules[0].required and projection.rules[1].has_default and not projection.rules[0].has_default
    assert projection.delete_path == "gone" and projection.delete_value is True
    assert [p["source"] for p in c.selected()] == ["trips"] and c.selected("trips")
    with pytest.raises(config.ConfigError):
        c.selected("j")


def test_all_faults_are_told_at_once():
    found = faults({"run": {"environment": "home", "batch_size": 0, "retry_factor": "x", "leases": "l", "lease_seconds": 5, "heartbeat_seconds": 5, "progress": "p", "gate": "g", "colour": 1}, "routing": {"document_below": 10, "relational_most": 5}, "mappings": [mapping(target="9x", write="merge", keys=["Gone"], compare=["Note", "Note"])]})
    text = " | ".join(found)
    for piece in ("run.environment: must be one of", "run.batch_size: must be above 0", "run.retry_factor:", "run.heartbeat_seconds:", "run.run_id: missing", "run.gate_scope: missing", "run.colour: unknown", "routing.relational_most:", "mappings[0].target: must be an identifier", "mappings[0].write:", "Gone isn't a column made", "compare: has a column twice"):
        assert piece in text, piece


@pytest.mark.parametrize(
    "more, piece",
    [
        ({"shards": 2}, "need a shard_mode"),
        ({"shards": 0}, "must be above 0"),
        ({"shards": 2, "shard_mode": "client_hash"}, "shard_key: missing"),
        ({"shards": 2, "shard_mode": "query_template", "query": "select 1"}, "query: has no shard marks"),
        ({"shards": 2, "shard_mode": "query_template", "query": "{{SHARD_INDEX}}", "incremental_query": "x"}, "incremental_query: has no shard marks"),
        ({"columns": [{"target": "Id", "source": "id", "convert": "magic"}]}, "convert: must be one of"),
        ({"keys": []}, "must not be empty"),
        ({"keys": [1]}, "not a list of texts"),
        ({"delete": {"equals": 1, "if": 2}}, "delete.if: unknown"),
    ],
)
def test_mapping_checks(more, piece):
    assert piece in " | ".join(faults({"mappings": [mapping(**more)]}))


def test_jobs_and_gates():
    job = {"name": "j", "api": "wide", "namespace": "n", "keys": ["k"]}
    assert "jobs: j is there twice" in faults({"jobs": [job, job]})
    assert any("require_gate" in f for f in faults({"run": {"require_gate": True}, "jobs": [job]}))
    assert any("isn't a name of a wide source" in f for f in faults({"jobs": [job | {"keys": ["a b"]}]}))
    assert config.parsed({"jobs": [job | {"api": "document", "keys": ["a b.c"]}]}).jobs
    assert faults({}) == ["neither mappings nor jobs"]
    ok = config.parsed({"run": {"require_gate": True, "environment": "prod", "gate": "g", "gate_scope": "s"}, "jobs": [job]})
    assert ok.fingerprint() == config.parsed({"run": {"log_format": "json"}, "jobs": [job]}).fingerprint() != config.parsed({"jobs": [job | {"namespace": "m"}]}).fingerprint()


def test_files_and_environment(tmp_path, monkeypatch):
    (tmp_path / "c.json").write_text(json.dumps({"run": {"run_id": "${TRIP_RUN}"}, "mappings": [mapping()]}))
    with pytest.raises(config.ConfigError):
        config.load(str(tmp_path / "c.json"))
    monkeypatch.setenv("TRIP_RUN", "r9")
    assert config.load(str(tmp_path / "c.json")).run["run_id"] == "r9"
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("jobs:\n- {name: j, api: document, namespace: n, keys: [k]}\n")
    assert config.load(str(tmp_path / "c.yaml")).jobs[0]["api"] == "document"


def test_booleans():
    assert [config.boolean(x) for x in (True, 0, 2.5, " Yes ", "n")] == [True, False, True, True, False]
    with pytest.raises(ValueError):
        config.boolean("maybe")


def test_places():
    t = config.control_table("table://p/i/d/Control?namespace=a")
    assert (t.project, t.instance, t.database, t.table, t.namespace) == ("p", "i", "d", "Control", "a")
    for bad in ("table://p/i/d/Control", "file://p/i/d/C?namespace=a", "table://p/i/C?namespace=a", "table://p/i/d/9?namespace=a"):
        with pytest.raises(ValueError):
            config.control_table(bad)
    assert config.object_place("s3://b/a/c") == ("s3", "b", "a/c")
    with pytest.raises(ValueError):
        config.object_place("s3://b")
