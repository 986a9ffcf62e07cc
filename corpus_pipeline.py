"""The text operators in a row: poor documents, copies, near copies and benchmark leaks go; the rest is packed.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes as Parquet in the shared folder
and reads again as the next stage's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.llm import decontamination, exact_dedup, near_dedup, packing, quality
from candlewick.llm.queries import TOKENIZER
from candlewick.llm.tables import ship_package, table, written


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.7 or more."""
    ship_package(spark)
    return quality.drop_poor(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    ship_package(spark)
    return exact_dedup.drop_copies(docs, keep="largest")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles and a similarity of 0.8 or more."""
    ship_package(spark)
    return near_dedup.drop_near_copies(docs, words=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no ten-word window of a benchmark item hits."""
    ship_package(spark)
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    ship_package(spark)
    return packing.pack(docs, TOKENIZER, capacity=2048, end_id=1)


STAGES = [
    ("quality", classified),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: Scores and packing can't be put in SQL; ``tests/llm`` compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return written(STAGES[-1][1](spark, docs, sf_dir), f"stage-{STAGES[-1][0]}")
