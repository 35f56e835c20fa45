"""The corpus pipeline: five stages over the table ``documents``.

Each stage takes what the one before it kept, written as Parquet and read again. All but the last return
the columns of ``documents``; ``n_chars`` follows the text wherever a stage shortens it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import line_dedup, mixing, near_dup, pieces, quality_rules
from orderloom.session import cut

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that break the base rules or lose too much."""
    return _measured(quality_rules.keep_good(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on too many documents of their source go; every document stays."""
    return _measured(line_dedup.without_boilerplate(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dup.without_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: a document appears as often as the mix takes it."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every text, with the text that they decode to."""
    return pieces.decode_texts(pieces.encode_texts(docs, F.xxhash64("doc_id", "text")))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("mix_sources", mixture),
    ("piece_sampling", tokens),
]

# Random rounding, hashed signatures and sampled pieces have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
