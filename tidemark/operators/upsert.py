"""Keyed upsert as a join: the batch, plus the target rows it does not hit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def survivors(target: DataFrame, batch_keys: DataFrame) -> DataFrame:
    """Rows of ``target`` whose key is not among ``batch_keys``."""
    return target.join(batch_keys, batch_keys.columns, "left_anti").select(*target.columns)


def upsert(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``target`` after ``batch`` is written over it.

    A batch row replaces every column of the target row with its key, or is
    new; other target rows stay.  The batch's keys must be unique and not
    NULL (see :mod:`tidemark.operators.checks`).  Only the batch's key
    columns enter the join; when they are small the target is not shuffled.
    """
    if set(target.columns) != set(batch.columns):
        raise ValueError("target and batch differ in their columns")
    return survivors(target, batch.select(*key)).unionByName(batch)


def affected_rows(batch: DataFrame) -> DataFrame:
    """One row: how many rows the upsert inserts or updates (all of them)."""
    return batch.agg(F.count(F.lit(1)).alias("affected_rows"))


def insert_update_split(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: how many batch rows are new and how many replace a row.

    The target's keys are narrowed to the batch's, a broadcast if the batch is
    small, and counted: they are the updated rows, and the rest is new.
    """
    keys = batch.select(*key)
    updated = target.select(*key).join(keys, list(key), "left_semi")
    rows = keys.select(F.lit(False).alias("hit")).unionAll(updated.select(F.lit(True)))
    hits = F.count_if(F.col("hit"))
    return rows.agg((F.count_if(~F.col("hit")) - hits).alias("inserted"), hits.alias("updated"))


def combine_counts(counts: dict[str, DataFrame]) -> DataFrame:
    """One row with a column per named one-row, one-column count frame."""
    named = [
        df.select(F.lit(name).alias("name"), F.col(df.columns[0]).alias("n"))
        for name, df in counts.items()
    ]
    stacked = named[0]
    for frame in named[1:]:
        stacked = stacked.unionAll(frame)
    return stacked.agg(
        *[F.sum(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in counts]
    )
