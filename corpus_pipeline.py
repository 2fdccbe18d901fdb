"""From raw documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.llm import near_copies, packing, pii, quality, toxicity
from paneloom.llm.queries import BYTE_TOKENIZER
from paneloom.llm.tables import read, save, small_batches


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, columns as they are."""
    return quality.keep_quality(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; learned from the labels of the documents at hand."""
    small_batches(spark)
    model = toxicity.train_toxicity(docs, read(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxicity_column(model)(F.col("text")) < 0.5)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id; of rows that repeat it, one.

    Near copies have a Jaccard similarity of five-word shingles of 0.8 or more; SimHash links and MinHash bands propose them. A group whose rows have no
    doc_id keeps one row.
    """
    return near_copies.keep_one_of_copies(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced by its kind in brackets and n_chars counted anew."""
    return pii.redact_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    return packing.pack_documents(docs, public_tokenizers.path(BYTE_TOKENIZER))


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("SimHash near-dedup", dedup_stage),
    ("PII", pii_stage),
    ("best-fit packing", packing_stage),
]

# Scores, fingerprints and packing have no SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; the last stage's rows."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir))
    return docs
