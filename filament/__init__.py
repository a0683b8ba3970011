"""filament — Spark-native ingestion and enrichment of delimited log / CDR files.

Every operator is a function over DataFrames; ``filament.plans.run`` strings
them into the per-run file lifecycle (list → ready → ledger → read → parse →
enrich → typed projection → per-file verdict → publish → ledger).
"""

from filament.spec import FieldSpec, PipelineSpec, TransformSpec, DedupSpec  # noqa: F401

__all__ = ["FieldSpec", "PipelineSpec", "TransformSpec", "DedupSpec"]
