"""Upkeep of a stored star join by its change.

A mart row changes with its fact or with a dimension row it shows.  So the change
of the join is: changed facts joined with the dimensions, other facts that show a
changed dimension row joined with the dimensions, and the keys of changed facts
that are in no row any more.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import star_join
from tidemark.specs import StarMart


def changed_keys(old: DataFrame, batch: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys of ``batch`` whose row is new or differs from that of ``old`` in one of
    ``columns``.  Old rows are narrowed to the batch's keys first."""
    look = F.struct(F.lit(True).alias("known"), *[c for c in columns if c != key])
    before = old.join(batch.select(key), key, "left_semi").select(key, look.alias("old"))
    return (
        batch.select(key, look.alias("new"))
        .join(before, key, "left")
        .where(~F.col("old").eqNullSafe(F.col("new")))
        .select(key)
    )


def facts_showing(
    mart: StarMart, facts: DataFrame, changed: Mapping[str, DataFrame]
) -> DataFrame:
    """The mart's key of facts that refer to a changed row of any dimension, found
    in one pass.  ``changed`` has a frame of keys for some dimensions."""
    references = [(name, column) for name, column in mart.joins if name in changed]
    found = facts.select(mart.key, *{column for _, column in references})
    for name, column in references:
        keys = changed[name].select(F.col(changed[name].columns[0]).alias(column))
        found = found.join(keys.withColumn(f"changed {name}", F.lit(True)), column, "left")
    hits = [F.col(f"changed {name}").isNotNull() for name, _ in references]
    return found.where(reduce(lambda a, b: a | b, hits)).select(mart.key)


@dataclass(frozen=True)
class MartDelta:
    """The mart's rows of the keys in ``affected`` go, and ``rows`` come."""

    rows: DataFrame
    affected: DataFrame

    @property
    def removed(self) -> DataFrame:
        """Affected keys that have no row any more."""
        key = self.affected.columns[0]
        return self.affected.join(self.rows.select(key), key, "left_anti")


def mart_delta(
    mart: StarMart, tables: Mapping[str, DataFrame], changed: Mapping[str, DataFrame]
) -> MartDelta:
    """How the mart changes with ``changed``: for the fact and for dimensions, where
    they have any, a frame with the keys of new or changed rows.  ``tables`` are
    the fact and the dimensions after the change."""
    facts = others = tables[mart.fact]
    parts = [facts.select(mart.key).where("false")]
    if mart.fact in changed:
        own = changed[mart.fact]
        parts.append(own.select(F.col(own.columns[0]).alias(mart.key)))
        others = facts.join(parts[-1], mart.key, "left_anti")
    if any(name in changed for name, _ in mart.joins):
        parts.append(facts_showing(mart, others, changed))
    affected = reduce(DataFrame.unionAll, parts)
    rows = star_join(mart, {**tables, mart.fact: facts.join(affected, mart.key, "left_semi")})
    return MartDelta(rows, affected)


def apply_delta(mart: DataFrame, delta: MartDelta) -> DataFrame:
    """The mart after the change."""
    rest = mart.join(delta.affected, delta.affected.columns[0], "left_anti")
    return rest.select(*mart.columns).unionByName(delta.rows)
