"""Columns that are computed once a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` and new columns behind a generator of one row.

    Adjacent projections and filters are merged by the optimizer, which puts
    an expression wherever its alias is used, also into lambdas, where it
    would run for every element. Nothing is merged across a generator.
    """
    return df.select("*", F.inline_outer(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))
