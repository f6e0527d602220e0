"""Date and timestamp expressions.

Everything works on timestamps without a time zone (``timestamp_ntz``), so a
result never depends on the session's zone.  All of it is built-in Catalyst
expressions: filters stay pushable and projections stay inside codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = str | dt.date | dt.datetime

# Fixed value: sub-second rounding changes direction at this instant (see
# ``round_to_second``).
ROUNDING_EPOCH = dt.datetime(2000, 1, 1)


def as_datetime(value: DateLike) -> dt.datetime:
    """Read a job argument as a zone-less instant; malformed text raises."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value.strip())
    if not isinstance(value, dt.datetime):
        return dt.datetime(value.year, value.month, value.day)
    return value.replace(tzinfo=None)


def as_date(value: DateLike) -> dt.date:
    """Read a job argument (``2021-01-01`` or a full timestamp) as a date."""
    return as_datetime(value).date()


def default_start(as_of: DateLike) -> dt.date:
    """Start of the default window: the day before ``as_of``."""
    return as_date(as_of) - dt.timedelta(days=1)


def to_date(ts: Column) -> Column:
    """Calendar day of a timestamp.  Catalyst unwraps range comparisons on
    this cast into comparisons on the bare column, so they reach the scan."""
    return ts.cast("date")


def _parsed(text: Column, type_name: str) -> Column:
    return F.coalesce(
        text.try_cast(type_name),
        F.when(
            text.isNotNull(),
            F.raise_error(F.concat(F.lit(f"not a {type_name}: "), text)),
        ),
    )


def text_to_date(text: Column) -> Column:
    """Text (a date or a full timestamp) to a date.  NULL stays NULL;
    malformed text fails the query whatever the session's ANSI setting is."""
    return _parsed(text, "date")


def text_to_timestamp(text: Column) -> Column:
    """Text to a zone-less timestamp, as strict as :func:`text_to_date`."""
    return _parsed(text, "timestamp_ntz")


def round_to_second(ts: Column) -> Column:
    """What ``timestamp(0)`` stores: the nearest whole second.

    An exact half second moves away from 2000-01-01: up after it, down
    before it.  (``date_trunc`` would go through the session's time zone, in
    which some local times do not exist.)
    """
    half = F.when(
        ts >= F.lit(ROUNDING_EPOCH), F.expr("interval 500000 microseconds")
    ).otherwise(F.expr("interval 499999 microseconds"))
    moved = ts + half
    seconds = F.extract(F.lit("SECOND"), moved)
    return moved - F.make_dt_interval(secs=seconds - F.floor(seconds))


def shift(ts: Column, months: int | Column = 0, days: int | Column = 0) -> Column:
    """``ts`` plus a calendar interval.  Months go first and clamp to the
    month's last day; either part may be negative."""
    interval = F.make_interval(
        months=months if isinstance(months, Column) else F.lit(months),
        days=days if isinstance(days, Column) else F.lit(days),
    )
    return ts + interval
