"""Length-limited text (``varchar(n)``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exceeds(text: Column, limit: int) -> Column:
    """True where the text does not fit ``varchar(limit)``.  Blanks beyond
    the limit do not count; NULL fits."""
    return F.coalesce(F.length(F.rtrim(text)) > limit, F.lit(False))


def drop_blank_excess(text: Column, limit: int) -> Column:
    """The stored form of a text: where only blanks stand beyond the limit
    they go.  Any other text is left whole, also one that does not fit (the
    check reports it)."""
    only_blanks_over = (F.length(text) > limit) & ~exceeds(text, limit)
    return F.when(only_blanks_over, F.rpad(F.rtrim(text), limit, " ")).otherwise(text)
