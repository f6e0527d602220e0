"""DataFrame-in, DataFrame-out operators."""

from tidemark.operators.bitmaps import integer_key_violations, integer_reference_violations
from tidemark.operators.checks import (
    ConstraintError,
    Profile,
    batch_profile,
    key_violations,
    profile_metrics,
    profile_of,
    reference_violations,
    require_known_parents,
    require_unique_keys,
    require_valid_batch,
    text_violations,
)
from tidemark.operators.joins import denormalise, star_join
from tidemark.operators.mart import (
    MartDelta,
    apply_delta,
    changed_keys,
    facts_showing,
    mart_delta,
)
from tidemark.operators.shape import conform, map_by_position, prune, rename_key, transform
from tidemark.operators.upsert import (
    affected_rows,
    combine_counts,
    insert_update_split,
    survivors,
    upsert,
)
from tidemark.operators.window import changed_between, changed_between_sql

__all__ = [
    "ConstraintError",
    "MartDelta",
    "Profile",
    "affected_rows",
    "apply_delta",
    "batch_profile",
    "changed_between",
    "changed_between_sql",
    "changed_keys",
    "combine_counts",
    "conform",
    "denormalise",
    "facts_showing",
    "insert_update_split",
    "integer_key_violations",
    "integer_reference_violations",
    "key_violations",
    "map_by_position",
    "mart_delta",
    "profile_metrics",
    "profile_of",
    "prune",
    "reference_violations",
    "rename_key",
    "require_known_parents",
    "require_unique_keys",
    "require_valid_batch",
    "star_join",
    "survivors",
    "text_violations",
    "transform",
    "upsert",
]
