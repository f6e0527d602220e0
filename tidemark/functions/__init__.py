"""Column expressions: dates, timestamps, limited text."""

from tidemark.functions.text import drop_blank_excess, exceeds
from tidemark.functions.timestamps import (
    as_date,
    as_datetime,
    default_start,
    round_to_second,
    shift,
    text_to_date,
    text_to_timestamp,
    to_date,
)

__all__ = [
    "as_date",
    "as_datetime",
    "default_start",
    "drop_blank_excess",
    "exceeds",
    "round_to_second",
    "shift",
    "text_to_date",
    "text_to_timestamp",
    "to_date",
]
