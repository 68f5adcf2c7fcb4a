"""Command line: python -m relweave --config FILE --phase query-gen|infer|generate|validate|all."""

from __future__ import annotations

import argparse
import json
import sys
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relweave import config as C
from relweave.functions import sqltext
from relweave.operators import graph as G
from relweave.operators import merge as M
from relweave.operators import profile as P
from relweave.plans import phases
from relweave.session import session
from relweave.sources import artifacts, catalog, overrides, rdf, results, worksheets
from relweave.sources.cache import PRINTS, Cache

#: Exit codes: what went wrong.
OK, CONFIG, PREREQUISITE, INVALID, INTERRUPTED = 0, 1, 2, 3, 130
#: What the log has for an error that nobody foresaw, which is raised.
FAILED = 1
PHASES = ("query-gen", "infer", "generate", "validate", "all")


def tables_of(spark: SparkSession, cfg: C.Config) -> dict[str, DataFrame]:
    """The Parquet tables below paths.tables, or the catalog's where there is no such folder."""
    p = Path(cfg.paths.tables)
    found = {x.name.removesuffix(".parquet"): spark.read.parquet(str(x)) for x in sorted(p.glob("*.parquet"))} if p.exists() else {t.name: spark.table(t.name) for t in spark.catalog.listTables() if not t.isTemporary}
    return {t: df for t, df in found.items() if (not cfg.include_tables or t in cfg.include_tables) and t not in cfg.exclude_tables}


def scanned(spark: SparkSession, folder: str | None) -> DataFrame:
    if not folder or not Path(folder).exists():
        raise C.Prerequisite(f"no folder of SQL worksheets: {folder}")
    return worksheets.scan(spark, folder)


def query_gen(spark: SparkSession, cfg: C.Config, sql_dir: str | None, label: str = "", now: datetime | None = None) -> Path:
    """A run folder with the profiling SQL and, as the tables are at hand, its results."""
    now = now or datetime.now(timezone.utc)
    sheets = scanned(spark, sql_dir)
    found = P.collected(phases.candidates(sheets))
    runs = Path(cfg.paths.runs)
    run = runs / artifacts.run_id([p.name for p in runs.glob("*")] if runs.exists() else [], now, label)
    for kind, name in (("edges", "01_profiling_edges.sql"), ("columns", "02_column_profiles.sql"), ("overlap", "03_value_overlap.sql")):
        p = run / "queries" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(P.emitted_sql(found, kind, cfg.profiling.sample_limit) + ";\n" if found else "-- no edges\n", encoding="utf-8")
    edges, columns, overlap = phases.profiled(spark, sheets, tables_of(spark, cfg), cfg)
    for df, name in ((edges, "profiling_edges.csv"), (columns, "column_profiles.csv"), (overlap, "value_overlap.csv")):
        if df is not None:
            (run / "results").mkdir(parents=True, exist_ok=True)
            df.toPandas().to_csv(run / "results" / name, index=False)  # a row per edge or column
    artifacts.write_report(str(run / "run_meta.json"), artifacts.run_meta(run.name, len(found), sum(c.ambiguous_direction for c in found), cfg.profiling.sample_limit or 0, worksheets.content_hash(sheets).first()[0], now))
    return run


def infer(spark: SparkSession, cfg: C.Config, sql_dir: str | None, run_dir: str | None, now: datetime | None = None) -> DataFrame:
    sheets = scanned(spark, sql_dir)
    told = sqltext.diagnostics(sheets).cache()
    per_file = [r.asDict() for r in told.orderBy("path").collect()]  # a row per worksheet
    artifacts.write_report(cfg.paths.ingest_diagnostics, {**sqltext.rolled_up(told).first().asDict(), "worksheets": per_file})
    told.unpersist()
    at = lambda name: str(Path(run_dir or "") / "results" / name)
    edges = columns = hints = None
    if run_dir:
        if not Path(run_dir).exists():
            raise C.Prerequisite(f"no run at {run_dir}")
        edges, columns, hints = results.edge_profiles(spark, at("profiling_edges.csv")), results.column_profiles(spark, at("column_profiles.csv")), results.last_direction_hints(spark, at("value_overlap.csv"))
    rel = phases.inferred(sheets, edges, hints, overrides.frame(spark, overrides.load(cfg.paths.overrides)), cfg)
    results.write_relationships(rel, cfg.paths.relationships)
    if edges is not None and columns is not None:
        issues = M.dq_issues(columns, edges, cfg.profiling.null_rate_warning)
        artifacts.write_report(cfg.paths.data_quality_report, {"run": Path(run_dir or "").name, "issues": [r.asDict() for r in issues.collect()], **M.dq_summary(issues).first().asDict()})
        artifacts.stamp_run(str(Path(run_dir or "") / "run_meta.json"), now or datetime.now(timezone.utc))
    return results.read_relationships(spark, cfg.paths.relationships)


def _relationships(spark: SparkSession, cfg: C.Config) -> DataFrame:
    if not Path(cfg.paths.relationships).exists():
        raise C.Prerequisite("no relationships; run infer first")
    return results.read_relationships(spark, cfg.paths.relationships)


def generate(spark: SparkSession, cfg: C.Config, force: list[str] | None = None, now: datetime | None = None) -> dict:
    """Write a version of the ontology. Only tables whose fingerprint changed since they were generated, and those in force, are generated again; the others' fragments come from the cache. Returns the tables in dependency order, and which were generated. All of it follows the schema, not the data."""
    now = now or datetime.now(timezone.utc)
    rel, over = _relationships(spark, cfg), overrides.load(cfg.paths.overrides)
    tables = tables_of(spark, cfg)
    declared, primary = catalog.declared(spark, cfg.paths.declared_keys)
    keys = phases.used_keys(rel, overrides.frame(spark, over), catalog.pairs(declared), cfg).cache()
    classes = overrides.classification(spark, over).select(F.upper("table").alias("k"), F.col("class").alias("classification"))
    upper = {t.upper(): t for t in tables}
    more = [r.from_table for r in keys.select("from_table").distinct().collect() if r.from_table.upper() not in upper]
    names = spark.createDataFrame([(t,) for t in [*tables, *more]], "name string")
    # A table that only relationships name has its properties, but no class of its own.
    named = names.join(classes, F.upper("name") == F.col("k"), "left").select("name", "classification")
    columns = catalog.columns_of(spark, tables)
    now_prints = phases.prints(named, columns, keys, primary).cache()
    prints = {r.table: r.asDict() for r in now_prints.collect()}
    cache = Cache(spark, cfg.paths.generation_cache)
    wanted = {t.upper() for t in force or []}
    stale = sorted(r.table for r in G.stale_tables(now_prints, cache.frame(), spark.createDataFrame([(t,) for t in wanted], "table string")).collect())
    now_prints.unpersist()
    if stale:
        only = lambda df, c: df.where(F.upper(c).isin(stale))
        made = phases.generated(only(named.where(F.col("name").isin(list(tables))), "name"), only(columns, "table"), only(keys, "from_table"), cfg)
        lines = rdf.n_triples(made, "table").groupBy("table").agg(F.array_join(F.sort_array(F.collect_set("line")), "\n").alias("text"))
        texts = {r.table: r.text for r in lines.collect()}
        stamp = now.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        for t in stale:
            cache.put(t, prints[t], texts.get(t, ""), stamp)
        artifacts.append_json(cfg.paths.provenance, *({"table": t, "made": stamp, "forced": t in wanted, **{k: prints[t][k] for k in PRINTS}} for t in stale))
        cache.save()
    lines = {x for t in prints for x in (cache.get(t) or {"content": ""})["content"].splitlines() if x}
    artifacts.versioned(cfg.paths.ontology, "".join(f"{x}\n" for x in sorted(lines)), now, ".nt")
    edges = [(upper[r.from_table.upper()], upper[r.to_table.upper()]) for r in keys.collect() if r.from_table.upper() in upper and r.to_table.upper() in upper]
    keys.unpersist()
    return {"tables": G.topological_order(list(tables), edges), "generated": stale, "cached": len(prints) - len(stale)}


def ontology(spark: SparkSession, cfg: C.Config) -> DataFrame:
    """The triples at paths.ontology: a version that generate wrote, line by line; a folder of such lines; or a file of people's own in the configured format."""
    p = Path(cfg.paths.ontology)
    if p.is_dir() or p.resolve().suffix == ".nt":
        return rdf.read_lines(spark, str(p.resolve()))
    return rdf.read(spark, str(p), cfg.ontology.format)


def validate(spark: SparkSession, cfg: C.Config) -> bool:
    rel = _relationships(spark, cfg)
    if not Path(cfg.paths.ontology).exists():
        raise C.Prerequisite("no ontology; run generate first")
    gates, parts = phases.validated(ontology(spark, cfg).cache(), rel, overrides.frame(spark, overrides.load(cfg.paths.overrides)), cfg)
    row = gates.first().asDict()
    artifacts.write_report(cfg.paths.validation_report, {"gates": row, **{k: [r.asDict() for r in df.collect()] for k, df in parts.items()}})
    return row["overall"] != "fail"


@contextmanager
def observed(cfg: C.Config, phase: str) -> Iterator[dict]:
    """Events at the beginning and the end of a phase, whatever ends it; what stands in the dict goes into the end's event."""
    began, more = time.time(), {"exit_code": OK}
    artifacts.append_json(cfg.paths.metrics, {"phase": phase, "event": "start", "status": "running"})
    try:
        yield more
    except BaseException as e:
        more |= {"exit_code": getattr(e, "code", None) or (INTERRUPTED if isinstance(e, KeyboardInterrupt) else FAILED), "error": str(e) or type(e).__name__}
        raise
    finally:
        status = "failed" if more["exit_code"] else "success"
        artifacts.append_json(cfg.paths.metrics, {"phase": phase, "event": "end", "status": status, "duration_ms": int(1000 * (time.time() - began)), "error": more.get("error"), **more})


def run(argv: list[str], spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="relweave", description=__doc__)
    ap.add_argument("--config", required=True)
    ap.add_argument("--phase", default="all", choices=PHASES)
    ap.add_argument("--sql-dir")
    ap.add_argument("--run-dir")
    ap.add_argument("--run-label", default="")
    ap.add_argument("--force-regenerate", action="append", metavar="TABLE", default=[])
    args = ap.parse_args(argv)
    wanted = ([p for p in ("infer", "generate", "validate") if p != "infer" or args.sql_dir]) if args.phase == "all" else [args.phase]
    try:
        cfg = C.load(args.config)
        spark = spark or session()
        for phase in wanted:
            with observed(cfg, phase) as told:
                if phase == "query-gen":
                    print(query_gen(spark, cfg, args.sql_dir, args.run_label))
                elif phase == "infer":
                    infer(spark, cfg, args.sql_dir, args.run_dir)
                elif phase == "generate":
                    done = generate(spark, cfg, args.force_regenerate)
                    told["counts"] = {"generated": len(done["generated"]), "cached": done["cached"]}
                    print(json.dumps(done))
                elif not validate(spark, cfg):
                    told["exit_code"] = INVALID
            if told["exit_code"]:
                return told["exit_code"]
    except (C.ConfigError, C.Prerequisite) as e:
        print(e, file=sys.stderr)
        return e.code
    except KeyboardInterrupt:
        return INTERRUPTED
    return OK


def main() -> None:
    sys.exit(run(sys.argv[1:]))
