"""The corpus pipeline of the training-data operators: see lectern.llm.pipeline, where the stages are."""

from __future__ import annotations

from lectern.llm.pipeline import COLUMNS, ORACLE_SQL, STAGES, blot_secrets, drop_near_duplicates, drop_toxic, mix_sources, pack_sequences, run

__all__ = ["COLUMNS", "ORACLE_SQL", "STAGES", "blot_secrets", "drop_near_duplicates", "drop_toxic", "mix_sources", "pack_sequences", "run"]
