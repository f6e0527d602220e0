"""Database tables over JDBC, as source and as stage sink.

The driver jar and the credentials are the caller's: pass them in
``properties`` (``driver``, ``user``, ``password``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Slices:
    """How one table is read in parallel: ``count`` ranges of ``column``
    (a number, date or timestamp; best an indexed one) between the bounds.
    The bounds only place the cuts; rows outside them are read too."""

    column: str
    lower: str | int
    upper: str | int
    count: int


class JdbcSource:
    """Tables and views of a database.

    Without ``slices`` a table is read over one connection, which suits small
    dimensions only.  A date window on the result is sent to the database as
    a range on the watermark column.  ``views`` names the views to take from
    the database rather than to join on Spark.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        tables: Mapping[str, object] | set[str],
        properties: Mapping[str, str] | None = None,
        slices: Mapping[str, Slices] | None = None,
        views: frozenset[str] = frozenset(),
        fetch_size: int = 10_000,
    ):
        self._spark, self._url = spark, url
        self._known = frozenset(tables) | views
        self._properties, self._slices = dict(properties or {}), dict(slices or {})
        self._fetch_size = fetch_size

    def provides(self, name: str) -> bool:
        return name in self._known

    def options(self, name: str) -> dict[str, str]:
        chosen = {
            **self._properties,
            "url": self._url,
            "dbtable": name,
            "fetchsize": str(self._fetch_size),
            # Zone-less database timestamps stay zone-less.
            "preferTimestampNTZ": "true",
        }
        if name in self._slices:
            cut = self._slices[name]
            chosen |= {
                "partitionColumn": cut.column,
                "lowerBound": str(cut.lower),
                "upperBound": str(cut.upper),
                "numPartitions": str(cut.count),
            }
        return chosen

    def table(self, name: str) -> DataFrame:
        return self._spark.read.format("jdbc").options(**self.options(name)).load()


def replace_options(
    url: str, table: str, properties: Mapping[str, str] | None = None, connections: int = 8
) -> dict[str, str]:
    """Options of a full replace that keeps the table's declared types."""
    return {
        **dict(properties or {}),
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "numPartitions": str(connections),
    }


def replace_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 8,
) -> None:
    """Replace a database table's rows with ``df``, over ``connections``."""
    options = replace_options(url, table, properties, connections)
    df.write.format("jdbc").mode("overwrite").options(**options).save()
