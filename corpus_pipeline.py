"""The corpus pipeline: its stages, and a run of them over documents."""

from relweave.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
