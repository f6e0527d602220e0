"""The text operators as one pipeline over ``documents``.

Every stage works on what the one before it kept, stored as Parquet in the
folder all executors share and read again.  All but the last return the columns
of ``documents``; the last returns the shard and slot of every row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, minmax_dedup, pu_quality, source_mix
from tidemark.llm.balanced_shards import balanced_shards
from tidemark.llm.stored import shared_folder
from tidemark.plans.files import delete_tree

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of quality 1, by a model learned from ``labels``.
    Null, empty and blank texts go; without labels nothing else does."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return pu_quality.keep_good(docs, pu_quality.train(docs, labels))


# The least similarity of near copies here.
SIMILAR_PERCENT = 80


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies: five-word
    shingles, a similarity of 0.8 or more.  Null, empty and blank texts and null ids
    have no copies; rows that repeat one id are one document."""
    return minmax_dedup.first_of_each_group(docs, SIMILAR_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a ``benchmark`` item occurs; null and empty
    texts have none, and an empty benchmark takes nothing."""
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of small sources up to twice.  Rows that repeat are one
    document; a null source is a source."""
    return source_mix.mixed_rows(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row, copies together; null texts are empty, and no rows
    have no shards."""
    return balanced_shards(docs).drop("text_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("sharding", sharding),
]

# A trained model and iterated labels: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage.  What a stage stored is deleted once the next
    one has stored its own."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_tree(spark, before)
        before = path
    return docs


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
