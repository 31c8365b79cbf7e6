"""Publish the mart tables and every report as named temporary views,
so they can be queried with ``spark.sql`` like database views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from salesmart.plans.model import Mart, Oltp


def register_views(spark: SparkSession, oltp: Oltp, mart: Mart, names: Iterable[str] | None = None) -> list[str]:
    """Temp views: the 8 mart tables under their own names, then one view
    per report (registry key). Views are lazy plans, nothing runs here."""
    from salesmart.registry import OPERATORS, apply

    done = []
    for name, df in mart.tables().items():
        df.createOrReplaceTempView(name)
        done.append(name)
    for name in (names or OPERATORS):
        apply(name, oltp, mart).createOrReplaceTempView(name)
        done.append(name)
    return done
