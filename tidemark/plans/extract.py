"""Which rows each entity contributes to a load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import as_date, default_start
from tidemark.functions.timestamps import DateLike
from tidemark.operators import affected_rows, changed_between, combine_counts, denormalise
from tidemark.sources import Source, read
from tidemark.specs import Entity, Model

# Writes a frame; returns it as read back, alone or with its number of ``rows`` and the
# ``low`` and ``high`` of its reference.
Store = Callable[[str, DataFrame], DataFrame | tuple[DataFrame, dict]]

# So many keys of ancestors are sent to all tasks, to drop other detail rows at their scan.
FEW_ANCESTORS = 500_000

# Keys this close together are told by their range, which costs no job.
SPREAD = 8


def _now() -> dt.datetime:
    """The session's wall clock; a constant that needs no job."""
    spark = SparkSession.active()
    return spark.sql("select cast(current_timestamp() as timestamp_ntz)").first()[0]


def window(date: DateLike | None, as_of: DateLike | None) -> tuple[dt.date, dt.date]:
    """The days ``[start, end)`` to load: from ``date`` (default: the day
    before ``as_of``) up to, not including, ``as_of`` (default: today, by the
    session's time zone and not the driver machine's)."""
    as_of = _now() if as_of is None else as_of
    start = default_start(as_of) if date is None else as_date(date)
    return start, as_date(as_of)


def _changed_details(
    model: Model,
    source: Source,
    entity: Entity,
    days: tuple[dt.date, dt.date],
    store: Store | None,
) -> DataFrame:
    """The view's rows in the window, narrowing the ancestors first where
    they carry the watermark.

    The planner cannot tell how few ancestors a window leaves.  Stored, their
    size is known: within the broadcast limit the detail rows, the largest
    table there is, are then scanned and joined without a shuffle.  What the source
    itself does to rows of one parent (such as numbering them) is, if the ancestors
    are few, done for theirs only: Spark moves this filter (unlike a join) below it.
    """

    def table(name: str) -> DataFrame:
        return read(model, source, name)

    view = model.views[entity.source]
    ancestors = view.ancestors(table)
    # Of a name both have, the view shows the detail rows' own.
    own = table(view.detail).columns
    if entity.watermark in own or entity.watermark not in ancestors.columns:
        return changed_between(table(entity.source), entity.watermark, *days)
    ancestors, details = changed_between(ancestors, entity.watermark, *days), table(view.detail)
    if store is not None:
        stored = store(f"{entity.source}_ancestors", ancestors)
        ancestors, found = stored if isinstance(stored, tuple) else (stored, None)
        # The window once more, as only a filtered side prunes the other's folders.
        ancestors = changed_between(ancestors, entity.watermark, *days)
        if found is not None and found["rows"] <= FEW_ANCESTORS:
            rows, low, high = (found[n] for n in ("rows", "low", "high"))
            reference, keys = F.col(view.reference), F.broadcast(ancestors.select(view.reference))
            near = low is None or high - low < SPREAD * rows
            details = details.where(reference.between(low, high) if near else reference.isin(keys))
    return denormalise(details, ancestors, view.reference, view.laid_out_by)


def extract(
    model: Model,
    source: Source,
    date: DateLike | None = None,
    as_of: DateLike | None = None,
    store: Store | None = None,
) -> dict[str, DataFrame]:
    """The rows of every entity that changed in the window.

    Lazy, but for what ``store`` is given to write: a function of a name and
    a frame that returns the frame as read back, alone or with what is known of it.
    """
    days = window(date, as_of)
    frames = {}
    for entity in model.entities:
        if entity.source in model.views and not source.provides(entity.source):
            frames[entity.name] = _changed_details(model, source, entity, days, store)
        else:
            rows = read(model, source, entity.source)
            frames[entity.name] = changed_between(rows, entity.watermark, *days)
    return frames


def extract_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row: how many rows each entity contributes."""
    return combine_counts({name: affected_rows(df) for name, df in frames.items()})
