"""The source writes a sentinel string where a value is unknown."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.schema import SENTINEL


def clean(col: str | Column, sentinels: Iterable[str] = (SENTINEL,)) -> Column:
    """NULL where the value is one of ``sentinels``; the value otherwise.

    With one sentinel this is ``NULLIF(col, sentinel)``. A literal
    ``'unknown'`` is *not* a sentinel and stays as it is.
    """
    c = F.col(col) if isinstance(col, str) else col
    sentinels = list(sentinels)
    if len(sentinels) == 1:
        return F.nullif(c, F.lit(sentinels[0]))
    return F.when(~c.isin(sentinels), c)


def clean_all(cols: Iterable[str], sentinels: Iterable[str] = (SENTINEL,)) -> list[Column]:
    """``clean`` applied to each named column, keeping the column name."""
    sentinels = tuple(sentinels)
    return [clean(c, sentinels).alias(c) for c in cols]
