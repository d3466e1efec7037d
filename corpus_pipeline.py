"""The corpus pipeline: toxicity, near-duplicates, personal data, packing, each on what the one before kept.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read again as the next one's docs.  All but the last keep the columns of docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import neardup, packing, pii, shared, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the folder's labels, does not reject."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, shared.table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return neardup.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked, n_chars counted anew."""
    return pii.redact(docs, pii.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: SQL cannot state the classifier, the signatures or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage returns is written to the shared folder and read again."""
    docs = shared.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = shared.cut(docs, f"stage-{name}")
    return docs
