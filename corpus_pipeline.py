"""A corpus pipeline over the table documents: each stage's result is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundshift.llm import decontaminate, language, near_dedup, pieces, suffix_dedup
from groundshift.llm.shared import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; und and undecided ones go."""
    return language.accepted(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies."""
    return near_dedup.one_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 100-byte strings that also start earlier."""
    cut = suffix_dedup.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, not even with other numbers or names."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids of the text, their number, and the digests of ids and of the decoded text."""
    return pieces.encode_with_digest(docs)


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", minhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]
#: SQL can express neither the classifier nor the signatures; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
