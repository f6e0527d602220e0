"""Rows written in the program."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def inline_rows(spark: SparkSession, schema: T.StructType, rows: Iterable[tuple]) -> DataFrame:
    """A DataFrame of literal rows, given in the schema's column order.

    Handed over as Arrow it is a local relation of known size, so the planner
    can broadcast it on evidence and drop joins with an empty one.
    """
    rows, arrow = list(rows), to_arrow_schema(schema)
    columns = [
        pa.array([row[i] for row in rows], type=field.type) for i, field in enumerate(arrow)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return inline_rows(spark, schema, [])
