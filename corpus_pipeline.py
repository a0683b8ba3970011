"""A training-corpus pipeline of five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``.  All but the last return the columns of
``documents``:

1. ``toxicity``: documents that the ordinal model (fitted on ``labels``) rejects go.
2. ``ngram_jaccard_join``: of documents linked by 5-word shingles with a similarity of 0.8
   or more, the one with the smallest id of each group stays.
3. ``benchmark_decontamination``: documents that hold a test item go.
4. ``secret_scan``: secrets in the texts are replaced by a mark; all documents stay.
5. ``packing``: the texts become token sequences; one row per piece.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filament.llm import decontaminate, ngram_join, packing, secret_scan, toxicity
from filament.llm.common import staged, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets; ``n_chars`` follows the new text."""
    out = secret_scan.redact_secrets(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", jaccard_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secrets_stage),
    ("packing", packing_stage),
]

#: models and tokenizers cannot be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), spark)
    return docs
