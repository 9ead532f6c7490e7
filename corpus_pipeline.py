"""The documents pipeline: stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir), works on every document that its predecessor
kept, and returns the columns of ``documents``; the last returns ids. Stages are
written as Parquet and reread, so a lost executor repeats one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardvigil.llm import bpe, decontaminate, line_dedup, near_dedup, quality_rules
from cardvigil.llm.tables import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality_rules.accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines go from the texts; every document stays."""
    return line_dedup.drop_shared_lines(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return near_dedup.without_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (binary, little-endian unsigned 32-bit) and the digest of what they decode to."""
    decoded = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text")))
    return decoded.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("byte-level BPE", tokens),
]

#: SQL has no BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = staged(docs, "pipeline")
    return docs
