"""The registered queries of the training-data operators, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    binary,
    filter_audit,
    fingerprints,
    licenses,
    mixing,
    ngram_join,
    oracles,
    packing,
    pieces,
    quality,
    site_tree,
    spelling,
    substring_dedup,
    surrogates,
)
from clickloom.llm.columns import word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op2_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return site_tree.extract(_table(spark, sf_dir, "pages"))


@_query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that are left when repeated windows go."""
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept_text")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by 0.9 of their 3-word shingles."""
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"), words=3, percent=90)


@_query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents over sequences of 1024 ids."""
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, vocabulary()).drop("ids")


@_query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.measure(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@_query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License blocks of all documents."""
    return licenses.scan(_table(spark, sf_dir, "documents"))


@_query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mixing.mix(docs, F.col("size")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@_query
def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs)


@_query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


@_query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and checksums of all documents, read back from the written files."""
    return binary.exported(_table(spark, sf_dir, "documents"), vocabulary())


@_query
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of all documents, begin and end id included, and of the texts decoded from them."""
    docs, model = _table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model")
    coded = pieces.decode_pieces(pieces.encode_pieces(docs, model), model)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@_query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents with their near words, forms and roots."""
    counts = spelling.word_counts(_table(spark, sf_dir, "documents"), least_chars=6, slip=199)
    return spelling.variants(counts, least_count=5, ratio=5)


@_query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of five filters in every order, for every source."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return filter_audit.audit_filters(filter_audit.failure_counts(docs, labels))


ORACLES = oracles.ORACLES
