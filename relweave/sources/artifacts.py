"""Runs, versions, logs and reports: small files that the driver writes."""

from __future__ import annotations

import json
import os
import re
import uuid
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

VERSION = r"_(\d{8}T\d{6}Z|\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2})\.\w+$"


def run_id(existing: list[str], now: datetime, label: str = "") -> str:
    """YYYY-MM-DD_NNN[_label]: NNN counts the runs of the UTC day."""
    day = now.astimezone(timezone.utc).strftime("%Y-%m-%d")
    return f"{day}_{1 + sum(x.startswith(day) for x in existing):03d}" + (f"_{label}" if label else "")


def versioned(path: str, content: str, now: datetime, suffix: str = "") -> str:
    """Write content beside path under a name with the time (and suffix, where path has none), and let path be a relative link to it. The link is made under another name and put in place in one step, so readers find the old version or the new one. A folder that stands at path is moved aside."""
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    out = p.with_name(f"{p.stem}_{now.astimezone(timezone.utc).strftime('%Y-%m-%dT%H-%M-%S')}{p.suffix or suffix}")
    out.write_text(content, encoding="utf-8")
    if p.is_dir() and not p.is_symlink():
        p.rename(p.with_name(f"{p.name}.old"))
    fresh = p.with_name(f".{p.name}.{uuid.uuid4().hex}")
    os.symlink(out.name, fresh)
    os.replace(fresh, p)
    return str(out)


def versions(files: DataFrame) -> DataFrame:
    """files (path) that carry a time, newest first, with `stamp`."""
    stamp = F.regexp_extract("path", VERSION, 1)
    return files.withColumn("stamp", stamp).where("stamp <> ''").orderBy(F.desc("stamp"), "path")


def latest(files: DataFrame) -> DataFrame:
    return versions(files).limit(1)


def listed(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("path")


def append_json(path: str, *rows: dict) -> None:
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    with p.open("a", encoding="utf-8") as f:
        f.writelines(json.dumps(r, ensure_ascii=False) + "\n" for r in rows)


def write_report(path: str, report: dict) -> None:
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(json.dumps(report, indent=2, ensure_ascii=False), encoding="utf-8")


def write_observed(df: DataFrame, path: str, mode: str = "errorifexists", **figures: Column) -> dict:
    """Write df as Parquet and return aggregates of its rows by name, taken in the pass that writes them: no further job looks at the rows. `rows` is always among them; of a table without rows sums are null."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in figures.items()]).write.mode(mode).parquet(path)
    return dict(seen.get)


def stamp_run(path: str, now: datetime) -> None:
    """Set downstream_run in a run's metadata."""
    p = Path(path)
    meta = json.loads(p.read_text(encoding="utf-8")) if p.exists() else {}
    write_report(path, meta | {"downstream_run": now.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")})


def run_meta(run: str, edges: int, ambiguous: int, sample: int, worksheets_hash: str, now: datetime) -> dict:
    return {"run_id": run, "created_at": now.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"), "edges": edges, "ambiguous_edges": ambiguous, "sample_limit": sample, "estimated_rows_k": edges * sample // 1000, "worksheets_hash": worksheets_hash}


def first_json(text: str) -> dict | None:
    """The first JSON object in a text, whatever stands around it."""
    decoder = json.JSONDecoder()
    for m in re.finditer(r"\{", text):
        try:
            value, _ = decoder.raw_decode(text, m.start())
        except ValueError:
            continue
        if isinstance(value, dict):
            return value
    return None


def first_object(text: Column) -> Column:
    """The first JSON object in a text, whatever stands around it, braces that begin none among it; null if there is none."""
    begins = F.filter(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substring(text, i, F.lit(1)) == "{")
    parsed = F.transform(begins, lambda i: F.get_json_object(F.substring(text, i, F.lit(2**31 - 1)), "$"))
    return F.get(F.filter(parsed, lambda x: x.startswith("{")), F.lit(0))


def extracted(rows: DataFrame, column: str, *paths: str) -> DataFrame:
    """rows with `content`: the value at the first JSON path that has one which isn't blank, in the text's first object; the text itself, without blanks at its ends, where no path has any. Null stays null."""
    body = F.transform(F.array(first_object(F.col(column))), lambda x: F.coalesce(*(F.nullif(F.trim(F.get_json_object(x, p)), F.lit("")) for p in paths)))[0]
    return rows.withColumn("content", F.coalesce(body, F.trim(F.col(column))))


def metadata_tables(rows: DataFrame, column: str, most: int = 200) -> DataFrame:
    """(table, comment) of a metadata service's answer {"tables": [{"name", "comment"}]}, the text's first object, of at most so many tables per answer."""
    got = F.from_json(first_object(F.col(column)), "tables array<struct<name:string,comment:string>>")
    return rows.select(F.explode(F.slice(F.coalesce(got.tables, F.array().cast("array<struct<name:string,comment:string>>")), 1, most)).alias("t")).select(F.col("t.name").alias("table"), F.col("t.comment").alias("comment"))
