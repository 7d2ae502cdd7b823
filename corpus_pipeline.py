"""A corpus pipeline of five of juriflow.llm's operators; each stage's result is written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from juriflow.llm import decontam, linededup, mixing, nearsets, quality
from juriflow.llm.common import checkpoint_dir


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line chunks seen before; those of which nothing is left go."""
    left = linededup.dedup(docs).where("NOT (removed_lines > 0 AND removed_lines = n_lines)")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return nearsets.keep(docs)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.drop(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy of a document."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", stage_quality),
    ("line_dedup", stage_line_dedup),
    ("near_dedup", stage_near_dedup),
    ("decontamination", stage_decontamination),
    ("mixing", stage_mixing),
]

#: BagMinHash classes and SimHash are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them is kept in the shared checkpoint folder."""
    checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{number}")
            docs = spark.read.parquet(f"{folder}/{number}")
    return docs
