"""The rules a database enforces by itself, as distributed checks.

Every check groups before it shuffles, so a key, parent or NULL that holds a
third of the rows crosses the network as one partial count per task.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import exceeds
from tidemark.operators.bitmaps import dense, repeated_ranges, stacked, unknown_ranges
from tidemark.specs import TargetSpec


class ConstraintError(ValueError):
    """A batch breaks a rule of its target; nothing is published."""


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that are NULL in part or occur more than once, with row counts."""
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.where((F.col("rows") > 1) | some_null)


def reference_violations(
    child: DataFrame, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Values of ``column`` that no parent row has, with their row counts.
    NULL references nothing and passes.  ``parent_key`` is unique in ``parent``.

    Values are counted first, so a hot parent arrives as partial counts.  Then
    the parent is narrowed to the referenced keys: against a small batch that
    is a broadcast join, and a large parent table is not shuffled.
    """
    referenced = _counted_references(child, [column])
    return _unknown(referenced, _numbered([parent.select(parent_key)])).select(
        F.col("value").alias(column), "rows"
    )


def _numbered(columns: Sequence[DataFrame]) -> DataFrame:
    """``number, value``: one-column frames under one another, with their place."""
    tagged = [
        df.select(F.lit(i).alias("number"), F.col(df.columns[0]).alias("value"))
        for i, df in enumerate(columns)
    ]
    return reduce(DataFrame.unionAll, tagged)


def _counted_references(child: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``number, value, rows`` of all references: each column is read once, and
    all are counted by one aggregate."""
    named = _numbered([child.select(column) for column in columns])
    return named.where("value is not null").groupBy("number", "value").agg(
        F.count(F.lit(1)).alias("rows")
    )


def _unknown(referenced: DataFrame, keys: DataFrame) -> DataFrame:
    """Referenced values that are no keys.  Both uses of ``referenced`` are the
    same aggregate, so its shuffle is planned once."""
    used = referenced.where("rows > 0")
    known = keys.join(used, ["number", "value"], "left_semi")
    return used.join(known, ["number", "value"], "left_anti")


def text_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows in which some text is longer than its limit."""
    return df.where(reduce(lambda a, b: a | b, [exceeds(F.col(c), n) for c, n in limits.items()]))


def batch_profile(
    batch: DataFrame, key: Sequence[str], limits: Mapping[str, int] | None = None
) -> DataFrame:
    """One row: ``rows``, ``null_keys``, ``duplicate_keys`` and, per limited
    text, ``<column>_too_long``.  One scan and one shuffle of keys for all."""
    limits = limits or {}
    over = {f"{c}_too_long": F.count_if(exceeds(F.col(c), n)) for c, n in limits.items()}
    per_key = batch.groupBy(*key).agg(
        F.count(F.lit(1)).alias("rows"), *[n.alias(name) for name, n in over.items()]
    )
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("rows"), zero).alias("rows"),
        F.coalesce(F.sum(F.when(some_null, F.col("rows"))), zero).alias("null_keys"),
        F.count_if((F.col("rows") > 1) & ~some_null).alias("duplicate_keys"),
        *[F.coalesce(F.sum(name), zero).alias(name) for name in over],
    )


@dataclass(frozen=True)
class Profile:
    """What the write of a batch tells: its rows, key range and partitions, the rules
    its rows break, and range and parents' partitions of each reference."""

    rows: int = 0
    low: int | None = None
    high: int | None = None
    buckets: frozenset[int] = frozenset()
    broken: Mapping[str, int] = field(default_factory=dict)
    references: Mapping[str, Profile] = field(default_factory=dict)


def profile_metrics(
    spec: TargetSpec, columns: Sequence[str], bits: Mapping[str, int]
) -> list[Column]:
    """Aggregates over a staged batch (of these columns) to observe as it is written.
    ``bits`` are the partition bits of the target and of the parents, by name."""
    staged = dict(zip(spec.columns, spec.staged_columns, strict=True))

    def extent(prefix: str, column: str, table: str) -> list[Column]:
        value = F.col(f"`{staged[column]}`").try_cast("bigint")
        return [
            F.count(value).alias(f"{prefix}rows"),
            F.min(value).alias(f"{prefix}low"),
            F.max(value).alias(f"{prefix}high"),
            # At most one number for each partition of the table.
            F.collect_set(F.shiftright(value, bits[table])).alias(f"{prefix}buckets"),
        ]

    found = [
        F.count(F.lit(1)).alias("all_rows"),
        F.count_if(F.col(f"`{staged[spec.key]}`").isNull()).alias("null_keys"),
        *extent("", spec.key, spec.name),
    ]
    for reference in spec.references:
        if staged[reference.column] in columns:
            found += extent(f"{reference.column} ", reference.column, reference.parent)
    for column, limit in spec.text_limits.items():
        if staged[column] in columns:
            text = F.col(f"`{staged[column]}`").cast("string")
            found.append(F.count_if(exceeds(text, limit)).alias(f"{column}_too_long"))
    return found


def profile_of(spec: TargetSpec, found: Mapping[str, object]) -> Profile:
    """The profile of a batch from its observed metrics."""

    def extent(prefix: str) -> dict:
        names = ("rows", "low", "high", "buckets")
        values = {name: found.get(f"{prefix}{name}") for name in names}
        return values | {"buckets": frozenset(values["buckets"] or ())}

    rules = ["null_keys", *[f"{c}_too_long" for c in spec.text_limits]]
    references = {
        r.column: Profile(**extent(f"{r.column} "))
        for r in spec.references
        if f"{r.column} rows" in found
    }
    return Profile(
        **extent("") | {"rows": found["all_rows"]},
        broken={rule: found[rule] for rule in rules if found.get(rule)},
        references=references,
    )


# How many offending keys an error message names.
SAMPLE = 5


def _sample(violations: DataFrame, columns: Sequence[str]) -> list[tuple]:
    return [tuple(r) for r in violations.select(*columns).limit(SAMPLE).collect()]


def require_valid_batch(batch: DataFrame, spec: TargetSpec, found: Profile) -> None:
    """Raise on NULL keys and over-long text."""
    if found.broken:
        sample = _sample(batch.where(F.col(spec.key).isNull()), [spec.key]) or _sample(
            text_violations(batch, spec.text_limits), [spec.key]
        )
        raise ConstraintError(f"{spec.name}: {dict(found.broken)}; for example keys {sample}")


def require_unique_keys(
    batches: Mapping[str, tuple[DataFrame, TargetSpec, Profile]],
) -> None:
    """Raise if a batch has a key twice.  Keys of all batches are looked at together,
    as bitmaps where they are dense."""
    keys = {
        name: batch.select(spec.key) for name, (batch, spec, found) in batches.items() if found.rows
    }
    compact = {n: k for n, k in keys.items() if dense(*_extent(batches[n][2]))}
    apart = {n: k for n, k in keys.items() if n not in compact}
    failing = []
    if compact:
        failing.append(repeated_ranges(stacked(compact), "value", ["name"]).select("name"))
    if apart:
        counted = stacked(apart).groupBy("name", "value").agg(F.count(F.lit(1)).alias("rows"))
        failing.append(counted.where("rows > 1").select("name"))
    if not failing:
        return
    for (name,) in reduce(DataFrame.unionAll, failing).limit(1).collect():
        batch, spec, _ = batches[name]
        twice = key_violations(batch, [spec.key])
        raise ConstraintError(
            f"{name}: {{'duplicate_keys': {twice.count()}}}; "
            f"for example keys {_sample(twice, [spec.key])}"
        )


def _extent(found: Profile) -> tuple[int, int | None, int | None]:
    return found.rows, found.low, found.high


def require_known_parents(
    batches: Mapping[str, tuple[DataFrame, TargetSpec, Profile]],
    parents: Callable[[str, Collection[int]], DataFrame],
) -> None:
    """Raise if a reference holds a value that is no key of its parent.
    ``parents(name, partitions)`` has the keys (one column) of a parent table in some
    partitions.  All references of all batches are compared together, as bitmaps
    where they are dense."""
    values, known, extents = {}, {}, {}
    for name, (batch, spec, found) in batches.items():
        for reference in spec.references:
            extent = found.references.get(reference.column)
            if extent is not None and extent.rows:
                label = f"{name}.{reference.column}"
                values[label] = batch.select(reference.column)
                known[label] = parents(reference.parent, extent.buckets)
                extents[label] = extent
    compact = [label for label in values if dense(*_extent(extents[label]))]
    apart = [label for label in values if label not in compact]
    failing = []
    if compact:
        children = stacked({label: values[label] for label in compact})
        keys = stacked({label: known[label] for label in compact})
        failing.append(unknown_ranges(children, keys, ["name"]).select("name"))
    if apart:
        children = stacked({label: values[label] for label in apart})
        keys = stacked({label: known[label] for label in apart})
        used = children.where("value is not null").distinct()
        failing.append(used.join(keys, ["name", "value"], "left_anti").select("name"))
    if not failing:
        return
    for (label,) in reduce(DataFrame.unionAll, failing).limit(1).collect():
        child, parent = values[label], known[label]
        unknown = reference_violations(
            child, child.columns[0], parent.distinct(), parent.columns[0]
        )
        count, rows = unknown.agg(F.count(F.lit(1)), F.sum("rows")).first()
        raise ConstraintError(
            f"{label}: {rows} rows reference {count} unknown keys; "
            f"for example {_sample(unknown, child.columns)}"
        )
