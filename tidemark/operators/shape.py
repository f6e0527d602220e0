"""Renaming, ordering and typing of extracted rows.  Projections only: none
of these moves a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import drop_blank_excess, round_to_second, text_to_timestamp
from tidemark.specs import Entity, TargetSpec


def rename_key(df: DataFrame, key: str, new_name: str) -> DataFrame:
    """Give the key its new name and make it the first column."""
    others = [F.col(c) for c in df.columns if c != key]
    return df.select(F.col(key).alias(new_name), *others)


def transform(frames: dict[str, DataFrame], entities: tuple[Entity, ...]) -> dict[str, DataFrame]:
    """Rename and promote the key of every extracted entity."""
    return {e.name: rename_key(frames[e.name], e.source_key, e.key) for e in entities}


def prune(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep the named columns, in that order; a missing one raises."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the batch: {missing}")
    return df.select(*columns)


def map_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    """Name the columns by their position, whatever they were called."""
    if len(df.columns) != len(names):
        raise ValueError(f"{len(df.columns)} columns cannot become {len(names)}")
    return df.toDF(*names)


def _stored(df: DataFrame, spec: TargetSpec, name: str) -> Column:
    column, have = F.col(name), df.schema[name].dataType
    want = spec.schema[name].dataType
    if isinstance(have, T.NullType):
        return column.cast(want).alias(name)
    if isinstance(have, T.StringType) and isinstance(want, T.TimestampNTZType):
        column = text_to_timestamp(column)
    elif isinstance(have, T.TimestampType) and isinstance(want, T.TimestampNTZType):
        column = column.cast(want)
    if name in spec.whole_seconds:
        column = round_to_second(column)
    if name in spec.text_limits:
        column = drop_blank_excess(column, spec.text_limits[name])
    return column.alias(name)


def conform(df: DataFrame, spec: TargetSpec) -> DataFrame:
    """Shape a staged batch as rows of its target table.

    Columns the target does not have go, the rest map by position, text
    timestamps are parsed, second precision and blank excess are settled, and
    what remains must be assignable to the declared type (a narrowing that
    overflows fails the job; an unrelated type fails the plan).
    """
    named = map_by_position(prune(df, spec.staged_columns), spec.columns)
    return named.select(*[_stored(named, spec, c) for c in spec.columns]).to(spec.schema)
