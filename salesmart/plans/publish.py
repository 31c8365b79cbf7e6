"""Publication S7 / S8.

S7: the BI tool imports the whole mart on refresh; ``publish`` copies
the current mart to an extract folder (Parquet per table, batch copy,
no service). S8: one report, as filtered on screen, exported to CSV.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from salesmart.plans.mart import write_mart
from salesmart.plans.model import Mart


def publish(mart: Mart, path: str) -> None:
    """Whole-mart extract, Parquet per table (facts by year)."""
    write_mart(mart, path)


def export_csv(report: DataFrame, path: str, single_file: bool = False) -> None:
    """A report as CSV with a header line.

    ``single_file`` gathers the rows into one task to write one file: only
    for reports whose size is bounded (a KPI row, a top-N); a full
    line-level report is written by all tasks in parallel.
    """
    df = report.coalesce(1) if single_file else report
    df.write.mode("overwrite").option("header", "true").csv(path)
