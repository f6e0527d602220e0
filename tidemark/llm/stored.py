"""Cutting lineage in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Rows of one Arrow batch: texts may be long, and a batch is held in memory.
ARROW_ROWS = 512


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; where that is
    unset (tests), one below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared").rstrip("/")


def prepare(spark: SparkSession) -> None:
    """Make ``checkpoint`` usable and keep Arrow batches small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df`` computed once and kept in the checkpoint folder, so
    that neither a later stage nor a lost executor computes them again."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)
