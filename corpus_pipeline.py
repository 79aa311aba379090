"""The corpus pipeline: documents through five operators of ``siltbed.llm``.

Every stage takes what the stage before kept and returns the columns of documents;
the last returns one row per document with its tokens' digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltbed.llm import bpe, decontam, pii, simhash, toxicity
from siltbed.llm.common import table
from siltbed.llm.queries import tokenizer_path, training
from siltbed.session import stage


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), usable=training)
    return toxicity.clean(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold benchmark passages."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind, lengths counted anew."""
    return pii.redacted(docs, pii.trained(), length_col="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe.digest(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", contamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# Trained models and components have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
