"""A training corpus in five stages, from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet
and read again as the ``docs`` of the next one, so a lost executor never costs more than one stage.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import decontaminate, packing, pii, quality_rules, simhash
from tillroll.llm.common import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the decision list learned from ``labels`` rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep_good(docs, quality_rules.learn(docs, labels))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that 4 or fewer bits of their marks link."""
    return simhash.keep_one(docs, shingle=4, radius=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the name of its kind."""
    return pii.redact(docs, pii.fit(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequence and their place in it."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # learned rules, redaction and tokenisation have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
