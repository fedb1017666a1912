"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows the one before kept and, but for the last, returns the columns of
``documents``. Stages have no limits of their own; what they do with nulls, empty and long
texts, ties, repeated rows and empty tables is written at their operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kessan.llm import anchored_pii, best_two_fit, ordinal_quality, relative_lz, simhash_blocks
from kessan.llm.columns import narrow, quoted, with_replaced
from kessan.session import scratch_path


def _retexted(docs: DataFrame, text) -> DataFrame:
    """``docs`` with new texts, and their lengths where the table names lengths."""
    replaced = with_replaced(docs, text=text)
    if "n_chars" not in docs.columns:
        return replaced
    kind = docs.schema["n_chars"].dataType
    return with_replaced(replaced, n_chars=F.char_length("text").cast(kind))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the highest grade by the ordinal model of the labels; the others go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = ordinal_quality.fit(narrow(docs, key="doc_id", text="text"), ordinal_quality.graded(labels))
    return ordinal_quality.select(docs, model, least_grade=2)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the one with the smallest id."""
    return simhash_blocks.one_per_component(docs, shingle=3, max_distance=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 35 words and more that occur again."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    found = relative_lz.remove_repeats(docs, window=35, rest=others)
    fields = [F.col("rest")[c].alias(c) for c in others]
    return _retexted(found.select("doc_id", F.col("kept").alias("text"), *fields).select(*map(quoted, docs.columns)), F.col("text"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked."""
    return _retexted(anchored_pii.mask(docs), F.col("text"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 1,024 tokens."""
    return best_two_fit.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Hashes, models and tokenizers are not to be had in SQL; tests/llm/test_pipeline.py checks run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
