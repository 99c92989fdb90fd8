"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from texttrend.llm import decontam, packing, quality, secrets, simhash
from texttrend.llm.common import read
from texttrend.session import store


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among ``docs``, scores at least 0.7.

    NULL and blank texts are scored like any other; without labels every score
    is 0.5 and no document stays; an empty table stays empty.
    """
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by at most 2 of 64 bits.

    Texts without words form one group; a row without an id stays only if its
    whole group has none.
    """
    return simhash.drop_near_duplicates(docs, width=3, max_bits=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; NULL and empty texts hold none."""
    return decontam.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked; n_chars follows where a text changes."""
    length = "n_chars" if "n_chars" in docs.columns else None
    return secrets.redact(docs, secrets.new_ledger(spark), length_col=length)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most 4,096 ids."""
    return packing.pack_documents(docs, end_id=1, capacity=4096)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scan),
    ("best-fit packing", best_fit_packing),
]

# The classifier is fitted and the packing is greedy: SQL states neither, the tests hold both against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again before the next."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = store(docs)
    return docs
