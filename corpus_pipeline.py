"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

Every stage works on all rows that its predecessor kept; all but the last return
the columns of documents. Null and empty texts, repeated rows and an empty table
pass as the operators define them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colloquy.llm import decontaminate, exact_dedup, near_dedup, sentencepieces, toxicity
from colloquy.llm.common import scratch, table
from colloquy.llm.registry import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity reaches the threshold; labels teach, they do not decide."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays, that of the largest id."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, that of the smallest id."""
    return near_dedup.near_dedup(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Columns of documents and n_pieces, ids_crc32, lossless, piece_ids; a column of documents that has such a name stays, the new one gets an underscore."""
    return sentencepieces.encode(docs, tokenizer_file("piece_bpe_32k.model"), names=("n_pieces", "ids_crc32", "lossless", "piece_ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepieces", to_pieces),
]

#: Trees, signatures and piece models are not SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
