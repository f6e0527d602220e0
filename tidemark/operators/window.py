"""The incremental extract: rows whose watermark falls in a date window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import as_date, to_date
from tidemark.functions.timestamps import DateLike


def changed_between(
    df: DataFrame, watermark: str, start: DateLike, end: DateLike
) -> DataFrame:
    """Rows whose ``watermark`` day is in ``[start, end)``.

    ``watermark`` may be a timestamp or a date.  Rows without one are never
    in the window.  On a timestamp column the comparison is unwrapped to a
    range on the column itself and pushed into the scan; on a column of a
    joined view it is pushed below the joins.
    """
    day = to_date(F.col(watermark))
    return df.where((day >= F.lit(as_date(start))) & (day < F.lit(as_date(end))))


_WINDOW = """
    select * from identifier(:table)
    where cast(identifier(:watermark) as date) >= :start
      and cast(identifier(:watermark) as date) < :end
"""


def changed_between_sql(
    spark: SparkSession, table: str, watermark: str, start: DateLike, end: DateLike
) -> DataFrame:
    """``changed_between`` over a table or view known to SQL by name.  Names and days
    are parameters of the statement, never part of its text: a name can only be a
    name."""
    days = {"start": as_date(start), "end": as_date(end)}
    return spark.sql(_WINDOW, args={"table": table, "watermark": watermark, **days})
