"""Where source tables come from.

A source answers ``table(name)`` with a lazy DataFrame.  Filters and column
choices made on it later reach the parquet or JDBC scan.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.joins import denormalise
from tidemark.specs import Model


class Source(Protocol):
    def table(self, name: str) -> DataFrame: ...

    def provides(self, name: str) -> bool: ...


class FrameSource:
    """Tables the caller already holds as DataFrames (catalog tables, other
    formats, derived data)."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        self._frames = dict(frames)

    def provides(self, name: str) -> bool:
        return name in self._frames

    def table(self, name: str) -> DataFrame:
        return self._frames[name]


class ParquetSource:
    """One parquet directory per table below ``root``, with declared schemas.

    """

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, T.StructType]):
        self._spark, self._root, self._schemas = spark, root.rstrip("/"), schemas

    def provides(self, name: str) -> bool:
        return name in self._schemas

    def table(self, name: str) -> DataFrame:
        schema = self._schemas[name]
        found = self._spark.read.schema(schema).parquet(f"{self._root}/{name}")
        return found.select(*schema.fieldNames())


def read(model: Model, source: Source, name: str) -> DataFrame:
    """A source table, in its declared types, or a view.  A view the source
    does not have itself is built here from its tables."""
    if name in model.sources:
        return source.table(name).to(model.sources[name])
    if source.provides(name):
        return source.table(name)

    def table(other: str) -> DataFrame:
        return read(model, source, other)

    view = model.views[name]
    return denormalise(
        table(view.detail), view.ancestors(table), view.reference, view.laid_out_by
    )


def declared_columns(schema: T.StructType, limits: Mapping[str, int]) -> str:
    """The columns of a table in SQL.  Limited text is ``VARCHAR(n)``: a write of
    longer text is refused, and blanks beyond the limit go."""
    return ", ".join(
        f"`{field.name}` "
        + (
            f"varchar({limits[field.name]})"
            if field.name in limits
            else field.dataType.simpleString()
        )
        for field in schema
    )


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Replace a catalog table whose files are bucketed and sorted by ``key``: joins
    and groups by the key of tables with as many buckets need no shuffle.  A bucket
    is one file; choose as many as make files of 128 MB to 1 GB."""
    placed = df.repartition(buckets, key).write.mode("overwrite").option("path", path)
    placed = placed.option("compression", "zstd")
    placed.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def write_by_column(df: DataFrame, path: str, column: str) -> DataFrame:
    """Replace a table laid out by ``column``, a folder for each of its values."""
    placed = df.hint("rebalance", column).write.mode("overwrite")
    placed.option("partitionOverwriteMode", "static").partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
