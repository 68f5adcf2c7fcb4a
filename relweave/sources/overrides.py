"""People's overrides in YAML."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

FIELDS = "kind string, from_table string, from_columns array<string>, to_table string, to_columns array<string>, relation string"


def load(path: str) -> dict:
    """Overrides with all their lists; a missing or empty file gives empty ones."""
    import yaml

    p = Path(path)
    data = (yaml.safe_load(p.read_text(encoding="utf-8")) if p.exists() else None) or {}
    return {"approve": data.get("approve") or [], "reject": data.get("reject") or [], "rename": data.get("rename") or [], "table_classification": data.get("table_classification") or {}}


def save(path: str, overrides: dict) -> None:
    import yaml

    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(yaml.safe_dump(overrides, sort_keys=False), encoding="utf-8")


def _columns(end: dict) -> list[str]:
    many = end.get("columns") or end.get("column") or []
    return [many] if isinstance(many, str) else list(many)


def frame(spark: SparkSession, overrides: dict) -> DataFrame:
    """approve and reject entries as rows; a scalar `column` is a list of one."""
    rows = [
        (kind, e.get("from", {}).get("table", ""), _columns(e.get("from", {})), e.get("to", {}).get("table", ""), _columns(e.get("to", {})), e.get("relation"))
        for kind in ("approve", "reject")
        for e in overrides.get(kind, [])
    ]
    return spark.createDataFrame(rows, FIELDS)


def classification(spark: SparkSession, overrides: dict) -> DataFrame:
    return spark.createDataFrame(list((overrides.get("table_classification") or {}).items()), "table string, class string")
