"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import automaton, blocks, chat, collocations, decontam, fingerprint, neighbours, packing, pii, quality, resampling, secrets, simhash
from .common import read


def op1_simhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate classes of whole texts: 3-word shingles, 2 bits."""
    return simhash.near_duplicates(read(spark, folder, "documents"), width=3, max_bits=2)


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of at most 4,096 ids."""
    return packing.pack_documents(read(spark, folder, "documents"), end_id=1, capacity=4096)


def op8_token_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as token-id blocks and read back from the files."""
    return blocks.round_trip(read(spark, folder, "documents"), end_id=2)


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents, each distinct text scanned once through a fresh ledger."""
    return secrets.digest(secrets.scan_versions(read(spark, folder, "documents"), secrets.new_ledger(spark)))


def op3_chat_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Every maximal conversation, rendered."""
    return chat.rendered(chat.maximal_conversations(read(spark, folder, "conversations")))


def op6_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of whole and edited texts: 5-word shingles, 512 bins, 4 bits."""
    return fingerprint.digest(fingerprint.beside_next(read(spark, folder, "documents")))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every (document, benchmark item) with a passage of the item in the document."""
    return decontam.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op9_backoff_automaton(spark: SparkSession, folder: str) -> DataFrame:
    """log10 probabilities of all texts under a model of the training texts."""
    return automaton.score_documents(read(spark, folder, "documents"))


def op2_quality_attention(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all whole texts, learned from the labels outside the held-out fold."""
    return quality.score_documents(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all whole texts."""
    return pii.digest(pii.find_personal_data(read(spark, folder, "documents")))


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """A tenth of the documents, drawn towards the benchmark's words; every document with its weight."""
    return resampling.resample(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 strongest phrases of 2 and 3 words of each language, over all documents."""
    return collocations.collocations(read(spark, folder, "documents"))


def op13_retrieval_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 1,024 ids, neighbours by BM25 together."""
    return neighbours.pack_by_retrieval(read(spark, folder, "documents"), end_id=0, capacity=1024)


QUERIES = {
    "op2_quality_attention": op2_quality_attention,
    "op3_chat_snapshots": op3_chat_snapshots,
    "op5_personal_data": op5_personal_data,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_decontamination": op7_decontamination,
    "op1_simhash_neardup": op1_simhash_neardup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op8_token_blocks": op8_token_blocks,
    "op9_backoff_automaton": op9_backoff_automaton,
    "op10_secret_scan": op10_secret_scan,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_retrieval_packing": op13_retrieval_packing,
}
ORACLES: dict[str, str] = {
    "op3_chat_snapshots": chat.ORACLE_SQL,
    "op10_secret_scan": secrets.ORACLE_SQL,
    "op11_importance_resampling": resampling.ORACLE_SQL,
    "op12_phrase_collocations": collocations.ORACLE_SQL,
}
