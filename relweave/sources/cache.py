"""What was generated of each table, with the fingerprints that it was generated from."""

from __future__ import annotations

import json
import warnings
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: What must be as it was for an entry to hold.
PRINTS = ("schema_hash", "fk_hash", "comment_hash", "classification")
ENTRY = "table string, schema_hash string, fk_hash string, comment_hash string, classification string, content string, made string"


class Cache:
    """Entries by table, in any case, in one JSON file that the driver keeps; a row per table of the schema. A file that isn't there or can't be read gives an empty cache (the latter with a warning)."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.changed = spark, Path(path), False
        self.entries: dict[str, dict] = {}
        try:
            rows = json.loads(self.path.read_text(encoding="utf-8"))["entries"] if self.path.exists() else []
            self.entries = {r["table"].upper(): {k: r[k] for k in (*PRINTS, "content", "made")} for r in rows}
        except (ValueError, KeyError, TypeError, AttributeError) as e:
            warnings.warn(f"{path} can't be read as a cache and counts as empty: {e!r}", stacklevel=2)

    def put(self, table: str, prints: dict, content: str, made: str = "") -> None:
        self.entries[table.upper()] = {k: prints[k] for k in PRINTS} | {"content": content, "made": made}
        self.changed = True

    def get(self, table: str) -> dict | None:
        return self.entries.get(table.upper())

    def holds(self, table: str, prints: dict) -> bool:
        """Whether there is an entry that was made from the same prints."""
        e = self.get(table)
        return e is not None and all(e[k] == prints[k] for k in PRINTS)

    def invalidate(self, table: str) -> bool:
        """Forget a table; whether it was known."""
        known = self.entries.pop(table.upper(), None) is not None
        self.changed |= known
        return known

    def clear(self) -> int:
        """Forget all; how many there were."""
        n = len(self.entries)
        self.entries, self.changed = {}, self.changed or n > 0
        return n

    def stats(self) -> dict[str, int]:
        """How many entries there are, and how many of each class."""
        out = {"entries": len(self.entries)}
        for e in self.entries.values():
            name = e["classification"] or "unclassified"
            out[name] = out.get(name, 0) + 1
        return out

    def save(self) -> None:
        """Write the file if anything changed."""
        if self.changed:
            self.path.parent.mkdir(parents=True, exist_ok=True)
            self.path.write_text(json.dumps({"entries": [{"table": t, **e} for t, e in sorted(self.entries.items())]}, indent=1, ensure_ascii=False), encoding="utf-8")
            self.changed = False

    def frame(self) -> DataFrame:
        """The entries as rows, for stale_tables()."""
        return self.spark.createDataFrame([(t, *(e[k] for k in (*PRINTS, "content", "made"))) for t, e in sorted(self.entries.items())], ENTRY)
