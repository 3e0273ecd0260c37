"""The training-data pipeline over ``documents``: classify, deduplicate, decontaminate, pseudonymize, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as
the next stage's documents.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.llm import importance, pfair, simhash, surrogates, templates
from parcelle.llm.tables import saved, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws (operator 10)."""
    return importance.quality_filter(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (operator 3)."""
    return simhash.simhash_dedup(docs, shingle=4, radius=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items, re-parameterised ones included (operator 4)."""
    return templates.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pseudonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates (operator 6); n_chars follows the new text."""
    return surrogates.pseudonymize(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in Pfair order of their sources (operator 5)."""
    return pfair.mix(docs)


STAGES = [("quality classifier", classify), ("simhash near-dedup", deduplicate), ("benchmark decontamination", decontaminate),
          ("pii surrogates", pseudonymize), ("source mixing", mix)]

#: Fingerprint components, hashed models and keyed surrogates have no SQL form; tests/llm/test_pipeline.py checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
