"""From raw documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from posterion.llm import importance, mixing, packing, pii, simhash
from posterion.llm.common import staged
from posterion.llm.queries import VOCABULARY, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling; the others go."""
    return importance.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    out = pii.redacted(docs, pii.train(spark))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix reads them, in training order."""
    return mixing.training_order(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequence and place."""
    return packing.packed(docs, VOCABULARY)


STAGES = [
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("packing", packed_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, name.replace(" ", "-"))
    return docs
