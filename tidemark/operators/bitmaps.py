"""Key rules by bitmaps: an integer key is a bit, 32,768 of them make a row of 4 KB.

What crosses the network is one bitmap for each task and range of keys it holds,
however many rows there are: for dense keys a thirtieth of the keys themselves.
Keys are only grouped one by one in the ranges that fail.  Any 64-bit key has its
bit, negative ones too; where keys are so sparse that a bitmap holds only a few
(see ``dense`` and ``FEW``), comparing keys moves less.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of a key with its row overhead, as a shuffle writes it.
KEY_BYTES = 16

# Keys of a range: the bits of a bitmap.
BITS = 32_768

# A range with fewer rows is compared by its keys: they take less than its bitmap.
FEW = BITS // 8 // KEY_BYTES

# So many failing ranges are named in the filter of the second pass; of more, the
# second pass is joined with them.
NAMED_RANGES = 10_000


def dense(rows: int, low: int | None, high: int | None) -> bool:
    """Whether the bitmaps of keys in ``[low, high]`` take less than ``rows`` keys."""
    return low is not None and (high - low) // 8 <= KEY_BYTES * rows


def _range(key: str) -> Column:
    return F.bitmap_bucket_number(key)


def _bits(key: str) -> Column:
    return F.bitmap_construct_agg(F.bitmap_bit_position(key))


def repeated_ranges(keys: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns and ``range`` of the ranges that hold a key more than once:
    they have more rows than bits."""
    known = keys.where(F.col(key).isNotNull())
    return (
        known.groupBy(*by, _range(key).alias("range"))
        .agg(F.count(F.lit(1)).alias("rows"), F.bitmap_count(_bits(key)).alias("bits"))
        .where("rows > bits")
        .select(*by, "range")
    )


def _within(
    failing: DataFrame, key: str, at: Column | None = None
) -> Callable[[DataFrame], DataFrame]:
    """Narrows frames to rows whose ``key`` is in a ``failing`` range (``at``, if it is
    not a 64-bit key's own).  These are found now: as a rule there are none or few, and
    then no other key is moved."""
    at = _range(key) if at is None else at
    found = failing.limit(NAMED_RANGES + 1).collect()
    if len(found) <= NAMED_RANGES:
        ranges = [row[0] for row in found]
        return lambda rows: rows.where(at.isin(ranges))
    return lambda rows: (
        rows.withColumn("range", at).join(failing, "range", "left_semi").drop("range")
    )


def integer_key_violations(df: DataFrame, key: str) -> DataFrame:
    """``key`` and ``rows`` of keys that are NULL or occur more than once: the
    ``key_violations`` of one column of integers, or of decimals without fraction, which
    may be wider than 64 bits.  Runs jobs that find the ranges to look at: those with
    more than one row, and of these with many rows only where a bitmap shows a repeat."""
    wide = isinstance(df.schema[key].dataType, T.DecimalType)
    keys = df.select(F.col(key).alias("key") if wide else F.col(key).cast("bigint").alias("key"))
    # A wide key's place in its range stands for it there, as any 64-bit number does.
    at = F.expr(f"(key - pmod(key, {BITS})) div {BITS}") if wide else _range("key")
    place = F.expr(f"cast(pmod(key, {BITS}) as bigint)") if wide else F.col("key")
    shared = (
        keys.where("key is not null")
        .groupBy(at.alias("range"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
    )
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(place))
    repeated = (
        _within(shared.where(f"rows >= {FEW}").select("range"), "key", at)(keys)
        .groupBy(at.alias("range"))
        .agg(F.count(F.lit(1)).alias("rows"), F.bitmap_count(bits).alias("bits"))
        .where("rows > bits")
        .select("range")
    )
    failing = repeated.unionAll(shared.where(f"rows < {FEW}").select("range"))
    found = (
        _within(failing, "key", at)(keys.where("key is not null"))
        .unionAll(keys.where("key is null"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows > 1 or key is null")
    )
    return found.select(F.col("key").cast(df.schema[key].dataType).alias(key), "rows")


def unknown_ranges(referenced: DataFrame, known: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns and ``range`` of the ranges where ``referenced`` has a ``value``
    that ``known`` has not: the bits of both are more than those of ``known``."""
    both = referenced.withColumn("parent", F.lit(False)).unionByName(
        known.withColumn("parent", F.lit(True))
    )
    position = "bitmap_bit_position(value)"
    return (
        both.where("value is not null")
        .groupBy(*by, _range("value").alias("range"))
        .agg(
            F.expr(f"bitmap_count(bitmap_construct_agg({position}))").alias("all"),
            F.expr(
                f"bitmap_count(bitmap_construct_agg({position}) filter (where parent))"
            ).alias("known"),
        )
        .where("all > coalesce(known, 0)")
        .select(*by, "range")
    )


def integer_reference_violations(
    child: DataFrame, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """``reference_violations`` of integer keys, which may repeat in ``parent``:
    values of ``column`` that no parent row has, with their row counts.  Runs a job
    that finds the ranges to look at."""
    values = child.select(F.col(column).cast("bigint").alias("value"))
    known = parent.select(F.col(parent_key).cast("bigint").alias("value"))
    within = _within(unknown_ranges(values, known), "value")
    return (
        within(values.where("value is not null"))
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(within(known), "value", "left_anti")
        .select(F.col("value").cast(child.schema[column].dataType).alias(column), "rows")
    )


def stacked(columns: Mapping[str, DataFrame]) -> DataFrame:
    """``name, value``: named frames of one integer column, under one another."""
    tagged = [
        df.select(F.lit(name).alias("name"), F.col(df.columns[0]).cast("bigint").alias("value"))
        for name, df in columns.items()
    ]
    return reduce(DataFrame.unionAll, tagged)
