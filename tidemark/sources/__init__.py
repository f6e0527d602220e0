"""Sources of rows: parquet, JDBC, caller's DataFrames, literal rows."""

from tidemark.sources.inline import empty_table, inline_rows
from tidemark.sources.jdbc import JdbcSource, Slices, replace_table
from tidemark.sources.tables import (
    FrameSource,
    ParquetSource,
    Source,
    declared_columns,
    read,
    write_bucketed,
    write_by_column,
)

__all__ = [
    "FrameSource",
    "JdbcSource",
    "ParquetSource",
    "Slices",
    "Source",
    "declared_columns",
    "empty_table",
    "inline_rows",
    "read",
    "replace_table",
    "write_bucketed",
    "write_by_column",
]
