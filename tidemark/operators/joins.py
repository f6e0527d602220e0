"""The two join shapes of the model: snowflake to fact, and star to mart.

Which side is small enough to broadcast is decided from measured sizes (the
planner's threshold, then AQE), and a shuffled join gets AQE's skew splitting,
so one hot parent does not become one long task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.specs import StarMart


def denormalise(
    detail: DataFrame, ancestors: DataFrame, reference: str, laid_out_by: str | None = None
) -> DataFrame:
    """``detail`` with the columns of its ancestors' row; without one a detail
    row drops out.

    The ancestors are joined among themselves before they come here: small
    next to the detail rows, so those are shuffled at most once, on one key.
    A column both have that the details are ``laid_out_by`` joins too, so that
    filtered ancestors prune the details' folders at run time.
    """
    keys = [reference, *([laid_out_by] if laid_out_by else [])]
    inherited = [c for c in ancestors.columns if c not in keys]
    own, parents = detail.alias("detail"), ancestors.alias("ancestors")
    same = [F.col(f"detail.`{c}`") == F.col(f"ancestors.`{c}`") for c in keys]
    return own.join(parents, same).select(
        *[F.col(f"detail.`{c}`") for c in detail.columns],
        # A name both sides have is the detail rows' own.
        *[F.col(f"ancestors.`{c}`") for c in inherited if c not in detail.columns],
    )


def star_join(mart: StarMart, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The mart's rows: the fact inner-joined to each dimension.  A fact whose
    reference is NULL or unknown has no row."""
    joined = tables[mart.fact].alias(mart.fact)
    for dimension, column in mart.joins:
        joined = joined.join(
            tables[dimension].alias(dimension),
            F.col(f"{mart.fact}.{column}") == F.col(f"{dimension}.{column}"),
        )
    return joined.select(
        *[F.col(f"{table}.{column}").alias(name) for table, column, name in mart.columns]
    )
