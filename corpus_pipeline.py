"""A corpus pipeline: stages over the documents, each one's rows written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickertide.llm.decontam import drop_contaminated
from tickertide.llm.exact import drop_duplicates
from tickertide.llm.mixing import mix
from tickertide.llm.nearcopies import drop_near_copies
from tickertide.llm.quality import keep_good
from tickertide.llm.registry import table
from tickertide.llm.shared import shared_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores one half or more."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), nameless=True)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix: documents as often as they are taken, with pass and shard."""
    return mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("mixed", mixed),
]
# The classifier and the near copies are beyond SQL; tests hold the stages against plain
# statements of what they do.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_path(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
