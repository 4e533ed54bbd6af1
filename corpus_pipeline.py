"""The training-data pipeline: clean, drop near copies, hide personal data, mix, pack.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import mixing, ngram_join, packing, quality, surrogates
from clickloom.llm.queries import vocabulary
from clickloom.llm.tables import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules and the base rules keep."""
    return quality.quality_filter(docs).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by 0.8 of their 5-word shingles.

    Documents without a word and rows without id are linked with nothing and stay; rows with equal ids are one document.
    """
    groups = ngram_join.jaccard_components(docs, words=5, percent=80, block_elements=1_200_000)
    gone = groups.where(F.col("component_id") < F.col("doc_id")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates."""
    hidden = surrogates.replace_entities(docs).drop("n_entities")
    return hidden.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: a row for every epoch of a document."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents over sequences of 1024 ids."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mixture),
    ("packing", packing_stage),
]

# Tokenizing and keyed surrogates are beyond SQL; the pipeline is tested on planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *stages, (_, last) = STAGES
    for name, stage in stages:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
