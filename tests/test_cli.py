"""All phases over a small schema, and what goes wrong."""

from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
import yaml

from relweave import cli, config
from relweave.cli import CONFIG, INVALID, OK, PREREQUISITE, run
from relweave.sources.cache import Cache


@pytest.fixture
def site(spark, tmp_path):
    t = tmp_path / "tables"
    spark.createDataFrame([(i, f"c{i}") for i in range(20)], "id int, name string").write.parquet(f"{t}/CUSTOMERS.parquet")
    spark.createDataFrame([(i, i % 20, i % 7) for i in range(100)], "id int, customer_id int, code int").write.parquet(f"{t}/ORDERS.parquet")
    spark.createDataFrame([(i,) for i in range(7)], "code int").write.parquet(f"{t}/CODES.parquet")
    (tmp_path / "sql").mkdir()
    (tmp_path / "sql/a.sql").write_text("SELECT * FROM ORDERS o JOIN CUSTOMERS c ON o.CUSTOMER_ID = c.ID JOIN CODES k ON o.CODE = k.CODE")
    (tmp_path / "o.yaml").write_text(yaml.safe_dump({"approve": [{"from": {"table": "orders", "columns": ["code"]}, "to": {"table": "codes", "columns": ["code"]}, "relation": "hasCode"}], "table_classification": {"ORDERS": "fact"}}))
    paths = {k: f"{tmp_path}/{v}" for k, v in {"tables": "tables", "overrides": "o.yaml", "runs": "runs", "relationships": "rel", "ontology": "onto", "data_quality_report": "dq.json", "validation_report": "val.json", "metrics": "m.jsonl", "ingest_diagnostics": "ingest.json", "provenance": "prov.jsonl", "generation_cache": "cache.json", "declared_keys": "keys.yaml"}.items()}
    (tmp_path / "c.yaml").write_text(yaml.safe_dump({"paths": paths}))
    return tmp_path


def test_phases(spark, site):
    cfg, sql = str(site / "c.yaml"), str(site / "sql")
    assert run(["--config", cfg, "--phase", "validate"], spark) == PREREQUISITE
    assert run(["--config", cfg, "--phase", "query-gen", "--sql-dir", sql, "--run-label", "x"], spark) == OK
    (done,) = (site / "runs").iterdir()
    assert done.name.endswith("_001_x") and {p.name for p in (done / "results").iterdir()} == {"profiling_edges.csv", "column_profiles.csv", "value_overlap.csv"}
    assert run(["--config", cfg, "--phase", "infer", "--sql-dir", sql, "--run-dir", str(done)], spark) == OK
    from relweave.sources.results import read_relationships

    got = {(r.from_table, r.to_table): (r.status, r.match_rate) for r in read_relationships(spark, str(site / "rel")).collect()}
    assert got[("ORDERS", "CUSTOMERS")] == ("approved", 1.0) and got[("ORDERS", "CODES")][0] == "approved"
    assert "downstream_run" in json.loads((done / "run_meta.json").read_text())
    assert run(["--config", cfg, "--phase", "generate"], spark) == OK
    assert run(["--config", cfg, "--phase", "validate"], spark) == OK
    report = json.loads((site / "val.json").read_text())
    assert report["gates"]["overall"] == "pass" and report["relation_names"][0]["outcome"] == "matched"
    events = [json.loads(x) for x in (site / "m.jsonl").read_text().splitlines()]
    assert [(e["phase"], e["event"], e["status"]) for e in events[:4]] == [("validate", "start", "running"), ("validate", "end", "failed"), ("query-gen", "start", "running"), ("query-gen", "end", "success")]
    assert [e["exit_code"] for e in events if e["event"] == "end"] == [2, 0, 0, 0, 0] and events[1]["error"]
    ingest = json.loads((site / "ingest.json").read_text())
    assert ingest["files"] == 1 and ingest["predicate_types"] == "eq_column_column=2" and ingest["worksheets"][0]["parsed_statement_count"] == 1


def test_failures(spark, site, monkeypatch):
    assert run(["--config", str(site / "none.yaml")], spark) == CONFIG
    assert run(["--config", str(site / "c.yaml"), "--phase", "infer", "--sql-dir", str(site / "nowhere")], spark) == PREREQUISITE
    bad = site / "bad.yaml"
    for text in ("review: {auto_approve_threshold: 2}", "unknown: 1", "ontology: {format: json}", ": : :", "paths: {tables: '${RELWEAVE_UNSET}'}"):
        bad.write_text(text)
        assert run(["--config", str(bad)], spark) == CONFIG
    monkeypatch.setenv("RELWEAVE_EMPTY", "")
    bad.write_text("paths: {tables: 'x/${RELWEAVE_EMPTY:-y}'}")
    assert config.load(str(bad)).paths.tables == "x/y"
    cfg = yaml.safe_load((site / "c.yaml").read_text())
    assert run(["--config", str(site / "c.yaml"), "--phase", "infer", "--sql-dir", str(site / "sql")], spark) == OK
    (site / "onto.ttl").write_text('<http://example.org/ontology#X> a <http://www.w3.org/2002/07/owl#Class> .')
    cfg["paths"]["ontology"], cfg["ontology"] = str(site / "onto.ttl"), {"format": "turtle"}
    bad.write_text(yaml.safe_dump(cfg))
    assert run(["--config", str(bad), "--phase", "validate"], spark) == INVALID


def test_generation_is_incremental(spark, site, monkeypatch):
    """Only tables whose schema, keys, comments or class changed are generated again; the ontology is whole all the same, and each run keeps a version."""
    cfg = config.load(str(site / "c.yaml"))
    cli.infer(spark, cfg, str(site / "sql"), None)
    at = lambda second: datetime(2026, 3, 2, 10, 0, second, tzinfo=timezone.utc)
    lines = lambda: (site / "onto").read_text().splitlines()
    one = cli.generate(spark, cfg, now=at(1))
    assert one["generated"] == ["CODES", "CUSTOMERS", "ORDERS"] and one["tables"].index("CODES") < one["tables"].index("ORDERS")
    whole = lines()
    two = cli.generate(spark, cfg, now=at(2))
    assert two["generated"] == [] and two["cached"] == 3 and lines() == whole
    # A class, a column, a declared key: each makes its own table stale.
    over = yaml.safe_load((site / "o.yaml").read_text())
    over["table_classification"]["CODES"] = "entity"
    (site / "o.yaml").write_text(yaml.safe_dump(over))
    assert cli.generate(spark, cfg, now=at(3))["generated"] == ["CODES"] and len(lines()) == len(whole) + 1
    spark.createDataFrame([(1, "x", 2)], "id int, name string, vip int").write.mode("overwrite").parquet(str(site / "tables/CUSTOMERS.parquet"))
    assert cli.generate(spark, cfg, now=at(4))["generated"] == ["CUSTOMERS"]
    (site / "keys.yaml").write_text(yaml.safe_dump({"keys": [{"table": "customers", "columns": ["vip"], "referred_table": "codes", "referred_columns": ["code"]}]}))
    assert cli.generate(spark, cfg, now=at(5))["generated"] == ["CUSTOMERS"] and any("hasCode>" in x and "range" in x for x in lines())
    assert cli.generate(spark, cfg, ["orders"], now=at(6))["generated"] == ["ORDERS"]
    # A cache that can't be read counts as empty; the result is the same.
    now = lines()
    (site / "cache.json").write_text("{broken")
    with pytest.warns(UserWarning, match="can't be read"):
        assert len(cli.generate(spark, cfg, now=at(7))["generated"]) == 3
    assert lines() == now and (site / "onto").is_symlink()
    assert sorted(p.name for p in site.glob("onto_*.nt")) == [f"onto_2026-03-02T10-00-0{k}.nt" for k in range(1, 8)]
    assert [(x["table"], x["forced"]) for x in map(json.loads, (site / "prov.jsonl").read_text().splitlines())][3:7] == [("CODES", False), ("CUSTOMERS", False), ("CUSTOMERS", False), ("ORDERS", True)]
    assert run(["--config", str(site / "c.yaml"), "--phase", "generate", "--force-regenerate", "codes", "--force-regenerate", "ORDERS"], spark) == OK
    end = [json.loads(x) for x in (site / "m.jsonl").read_text().splitlines()][-1]
    assert end["counts"] == {"generated": 2, "cached": 1} and end["status"] == "success"


def test_unforeseen_errors_end_their_phase(spark, site, monkeypatch):
    monkeypatch.setattr(cli, "infer", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(["--config", str(site / "c.yaml"), "--phase", "infer", "--sql-dir", str(site / "sql")], spark)
    events = [json.loads(x) for x in (site / "m.jsonl").read_text().splitlines()]
    assert [(e["event"], e["status"]) for e in events] == [("start", "running"), ("end", "failed")] and "division" in events[1]["error"]


def test_cache(spark, tmp_path):
    c = Cache(spark, f"{tmp_path}/c.json")
    prints = {"schema_hash": "a", "fk_hash": "b", "comment_hash": "c", "classification": None}
    assert c.get("x") is None and not c.holds("x", prints) and not c.invalidate("x") and c.clear() == 0 and not c.changed
    c.put("Orders", prints, "text \u00e9")
    c.put("b", prints | {"classification": "fact"}, "")
    assert c.holds("ORDERS", prints) and not c.holds("orders", prints | {"classification": "fact"}) and c.stats() == {"entries": 2, "unclassified": 1, "fact": 1}
    c.save()
    again = Cache(spark, f"{tmp_path}/c.json")
    assert again.entries == c.entries and again.invalidate("orders") and again.get("Orders") is None and again.clear() == 1
    again.save()
    assert Cache(spark, f"{tmp_path}/c.json").entries == {}
    for bad in ('{"entries": [{"table": "t"}]}', '[]', '{"entries": 3}', ""):
        (tmp_path / "c.json").write_text(bad)
        with pytest.warns(UserWarning, match="can't be read"):
            assert Cache(spark, f"{tmp_path}/c.json").entries == {}
