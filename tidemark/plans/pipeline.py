"""The load job: extract, transform, stage, check, upsert, refresh."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timestamps import DateLike
from tidemark.operators import (
    Profile,
    affected_rows,
    apply_delta,
    changed_keys,
    combine_counts,
    conform,
    facts_showing,
    mart_delta,
    profile_metrics,
    profile_of,
    require_known_parents,
    require_unique_keys,
    require_valid_batch,
    star_join,
    transform,
)
from tidemark.plans.extract import extract
from tidemark.plans.warehouse import Warehouse
from tidemark.sources import Source
from tidemark.specs import Model, TargetSpec

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadResult:
    """``affected`` counts inserted plus updated rows per entity; as every
    staged row is one or the other, it is also the number extracted."""

    affected: dict[str, int]
    staged: dict[str, DataFrame]

    def frame(self) -> DataFrame:
        """The counts as one row, a column per entity, from the stages."""
        return combine_counts(
            {f"affected_rows_{name}": affected_rows(df) for name, df in self.staged.items()}
        )


@dataclass(frozen=True)
class Batch:
    """A staged batch in its target's shape, and what its write has told."""

    rows: DataFrame
    target: TargetSpec
    profile: Profile


def _together(spark: SparkSession, jobs: Sequence[Callable[[], object]]) -> list:
    """Submit independent jobs at once, so that small ones do not leave the
    cluster waiting for each other; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=max(len(jobs), 1)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [future.result() for future in running]


def _stage(warehouse: Warehouse, target: TargetSpec, frame: DataFrame) -> tuple[DataFrame, dict]:
    bits = {name: warehouse.model.bucket_bits(name) for name in warehouse.model.targets}
    metrics = profile_metrics(target, frame.columns, bits)
    return warehouse.stage(target.name, frame, *metrics)


def _check(warehouse: Warehouse, batches: Mapping[str, Batch]) -> None:
    """Raise if a rule is broken, before any table is written."""
    for batch in batches.values():
        require_valid_batch(batch.rows, batch.target, batch.profile)
    checked = {name: (b.rows, b.target, b.profile) for name, b in batches.items()}

    def parents(name: str, buckets: frozenset[int]) -> DataFrame:
        """Keys of a parent as the load will leave it."""
        key = warehouse.model.key_of(name)
        return warehouse.rows(name, buckets).select(key).unionAll(batches[name].rows.select(key))

    _together(
        warehouse.spark,
        [partial(require_unique_keys, checked), partial(require_known_parents, checked, parents)],
    )


@dataclass(frozen=True)
class Changes:
    """Keys of rows that will look different in the mart, by table, and the mart's
    partitions of those of the fact."""

    keys: dict[str, DataFrame]
    buckets: frozenset[int]


def _changes(warehouse: Warehouse, batches: Mapping[str, Batch]) -> Changes:
    """What the batches change, compared with the tables before they are written."""
    mart = warehouse.model.mart
    parts = []
    for name, key in [(mart.fact, mart.key), *mart.joins]:
        batch = batches[name]
        old = batch.profile.buckets & warehouse.buckets(name) if batch.profile.rows else set()
        # Facts cannot show yet what has no old row.
        if old or (name == mart.fact and batch.profile.rows):
            columns = mart.looked_at(name)
            keys = changed_keys(warehouse.rows(name, old), batch.rows, key, columns)
            parts.append(
                keys.select(F.lit(name).alias("name"), F.col(key).cast("bigint").alias("key"))
            )
    if not parts:
        return Changes({}, frozenset())
    stored, found = warehouse.store(
        "changed_keys",
        reduce(DataFrame.unionAll, parts),
        F.collect_set("name").alias("names"),
        _fact_buckets(warehouse, F.when(F.col("name") == mart.fact, F.col("key"))),
    )
    keys = {name: stored.where(F.col("name") == name).select("key") for name in found["names"]}
    return Changes(keys, frozenset(found["buckets"]))


def _fact_buckets(warehouse: Warehouse, key: Column) -> Column:
    """At most one number for each of the mart's partitions."""
    return F.collect_set(warehouse.bucket_of(warehouse.model.mart.name, key)).alias("buckets")


def refresh_mart(warehouse: Warehouse, changes: Changes | None = None) -> None:
    """Bring the mart up to date with its tables: by what has changed, or (None) as
    a whole.  Only partitions with affected rows are read and written."""
    mart, name = warehouse.model.mart, warehouse.model.mart.name
    shown = {
        dimension: warehouse.rows(dimension).select(
            column, *[c for c in mart.visible(dimension) if c != column]
        )
        for dimension, column in mart.joins
    }
    if changes is None:
        facts = warehouse.rows(mart.fact)
        everywhere = warehouse.buckets(mart.fact) | warehouse.buckets(name)
        warehouse.replace(name, star_join(mart, shown | {mart.fact: facts}), everywhere)
        return
    if not changes.keys:
        return
    own = changes.keys.get(mart.fact)
    dimensions = {n: keys for n, keys in changes.keys.items() if n != mart.fact}
    affected, buckets = own, changes.buckets
    if dimensions:
        facts = warehouse.rows(mart.fact)
        parts = [facts_showing(mart, facts, dimensions).toDF("key")]
        if own is not None:
            parts.append(own)
        affected, found = warehouse.store(
            "affected_keys",
            reduce(DataFrame.unionAll, parts).distinct(),
            _fact_buckets(warehouse, F.col("key")),
        )
        buckets = frozenset(found["buckets"])
    if buckets:
        facts = warehouse.rows(mart.fact, buckets)
        delta = mart_delta(mart, shown | {mart.fact: facts}, {mart.fact: affected})
        warehouse.replace(name, apply_delta(warehouse.rows(name, buckets), delta), buckets)


def load(model: Model, frames: dict[str, DataFrame], warehouse: Warehouse) -> LoadResult:
    """Stage transformed frames, upsert them all and refresh the mart.

    Every stage is replaced first.  All rules are checked before any table is
    written, so a batch that breaks one changes only the stages.  Loading the
    same frames again changes nothing, so a load that stopped halfway is run again.
    """
    spark, entities = warehouse.spark, model.entities
    written = _together(
        spark, [partial(_stage, warehouse, e.target, frames[e.name]) for e in entities]
    )
    staged = {e.name: rows for e, (rows, _) in zip(entities, written, strict=True)}
    batches = {}
    for entity, (rows, found) in zip(entities, written, strict=True):
        target, profile = entity.target, profile_of(entity.target, found)
        # Told before any check, for whoever has to see why one failed.
        log.info("extracted %s rows: %d", entity.name, profile.rows)
        batches[target.name] = Batch(conform(rows, target), target, profile)
    _check(warehouse, batches)
    changes = _changes(warehouse, batches) if warehouse.buckets(model.mart.fact) else None
    # Parents first: no reader meets a fact without them.
    for group in model.load_order():
        written = [batches[e.target.name] for e in group]
        _together(
            spark,
            [partial(warehouse.upsert, b.target.name, b.rows, b.profile.buckets) for b in written],
        )
    refresh_mart(warehouse, changes)
    affected = {e.name: batches[e.target.name].profile.rows for e in entities}
    log.info("loaded %s", affected)
    return LoadResult(affected, staged)


def run(
    model: Model,
    source: Source,
    warehouse: Warehouse,
    date: DateLike | None = None,
    as_of: DateLike | None = None,
) -> LoadResult:
    """Load what changed on the days ``[date, as_of)``.

    By default that is yesterday.  An earlier ``date`` catches up or fills in
    history with the same code; running a window again changes nothing.
    """

    def store(name: str, df: DataFrame) -> tuple[DataFrame, dict]:
        key = model.views[name.removesuffix("_ancestors")].reference
        extent = [F.count(F.lit(1)).alias("rows"), F.min(key).alias("low"), F.max(key).alias("high")]
        return warehouse.store(name, df, *extent)

    extracted = extract(model, source, date, as_of, store)
    return load(model, transform(extracted, model.entities), warehouse)
