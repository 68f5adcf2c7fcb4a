"""Settings from YAML: defaults, bounds and environment variables."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any

VARIABLE = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}")


class ConfigError(Exception):
    """Exit code 1."""

    code = 1


class Prerequisite(Exception):
    """Exit code 2: what a phase needs isn't there."""

    code = 2


@dataclass
class Review:
    auto_approve_threshold: float = 0.95
    auto_approve_confidence: float = 0.80


@dataclass
class Profiling:
    sample_limit: int | None = None
    match_rate_threshold: float = 0.95
    null_rate_warning: float = 0.20
    frequency_boost_5: float = 0.05
    frequency_boost_10: float = 0.10


@dataclass
class Validation:
    coverage_warn_threshold: float = 0.50
    coverage_pass_threshold: float = 0.90
    allow_duplicate_iris: bool = False


@dataclass
class Ontology:
    base_iri: str = "http://example.org/ontology#"
    format: str = "turtle"


@dataclass
class Paths:
    tables: str = "data/tables"
    overrides: str = "data/overrides.yaml"
    runs: str = "runs"
    relationships: str = "data/relationships"
    ontology: str = "data/ontology"
    data_quality_report: str = "data/data_quality_report.json"
    validation_report: str = "data/validation_report.json"
    metrics: str = "data/metrics.jsonl"
    ingest_diagnostics: str = "data/sql_ingest_diagnostics.json"
    provenance: str = "data/provenance.jsonl"
    generation_cache: str = "data/generation_cache.json"
    declared_keys: str = "data/declared_keys.yaml"


@dataclass
class Config:
    review: Review = field(default_factory=Review)
    profiling: Profiling = field(default_factory=Profiling)
    validation: Validation = field(default_factory=Validation)
    ontology: Ontology = field(default_factory=Ontology)
    paths: Paths = field(default_factory=Paths)
    include_tables: list[str] = field(default_factory=list)
    exclude_tables: list[str] = field(default_factory=list)


#: Settings that are shares.
RATES = {"auto_approve_threshold", "auto_approve_confidence", "match_rate_threshold", "null_rate_warning", "coverage_warn_threshold", "coverage_pass_threshold"}


def filled(value: Any) -> Any:
    """value with ${NAME} and ${NAME:-default} replaced in its texts; an empty variable counts as unset."""
    if isinstance(value, dict):
        return {k: filled(v) for k, v in value.items()}
    if isinstance(value, list):
        return [filled(v) for v in value]
    if not isinstance(value, str):
        return value

    def one(m: re.Match) -> str:
        found = os.environ.get(m[1]) or m[2]
        if found is None:
            raise ConfigError(f"the environment variable {m[1]} is needed")
        return found

    return VARIABLE.sub(one, value)


def _made(kind: type, data: Any, where: str) -> Any:
    if not isinstance(data, dict):
        raise ConfigError(f"{where or 'the file'} isn't a mapping")
    known = {f.name: f for f in fields(kind)}
    if unknown := set(data) - set(known):
        raise ConfigError(f"unknown settings: {', '.join(sorted(where + u for u in unknown))}")
    out = kind()
    for name, value in data.items():
        now = getattr(out, name)
        if is_dataclass(now):
            value = _made(type(now), value or {}, f"{name}.")
        elif name in RATES and not (isinstance(value, (int, float)) and 0 <= value <= 1):
            raise ConfigError(f"{where}{name} must be between 0 and 1")
        setattr(out, name, value)
    if isinstance(out, Ontology) and out.format not in ("xml", "turtle", "n3"):
        raise ConfigError("ontology.format must be xml, turtle or n3")
    return out


def load(path: str) -> Config:
    import yaml

    p = Path(path)
    if not p.exists():
        raise ConfigError(f"no configuration at {path}")
    try:
        data = yaml.safe_load(p.read_text(encoding="utf-8")) or {}
    except yaml.YAMLError as e:
        raise ConfigError(f"{path} isn't YAML: {e}") from e
    return _made(Config, filled(data), "")
