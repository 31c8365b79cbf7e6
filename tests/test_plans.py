"""Plan assertions: pruning, pushdown, broadcast of the calendar only, no
single-partition windows or cross joins in the scale-sensitive operators."""

from __future__ import annotations

import pytest

from mart_samples import SF0001
from salesmart import Period
from salesmart.operators import finance
from salesmart.plans.mart import build_mart, load_mart
from salesmart.sources.testdata import load_oltp


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def persisted(spark):
    import tempfile

    root = tempfile.mkdtemp(prefix="salesmart-plan-", dir="/tmp")
    return load_mart(load_oltp(spark, SF0001), root)


def test_f2_single_fact_scan_pruned_columns(persisted):
    p = plan(finance.f2_revenue_product(persisted))
    assert p.count("fait_ventes") == 1
    assert "ReadSchema: struct<date_key:int,produit_key:bigint,montant_net:decimal(18,2)>" in p
    assert "Expand" in p                     # grouping sets, not a union of two aggregates


def test_period_filter_prunes_partitions_and_pushes_key_range(persisted):
    p = plan(finance.f2_revenue_product(persisted, Period(annee=1998, mois=8)))
    assert "PartitionFilters: [isnotnull(annee" in p and "(annee#" in p
    assert "GreaterThanOrEqual(date_key,19980801)" in p and "LessThanOrEqual(date_key,19980831)" in p


def test_no_cross_join_or_global_window(persisted):
    for df in (finance.vf8_top_customers(persisted), finance.f8_top_customers_period(persisted)):
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
        assert "SinglePartition" not in p or "TakeOrderedAndProject" in p


def test_order_totals_are_aggregated_not_windowed(spark):
    m = build_mart(load_oltp(spark, SF0001))
    p = m.fait_ventes._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in p


def test_scale_settings_for_100_tb():
    from salesmart.session import scale_settings

    conf = scale_settings(100 * 10**12, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 << 20))
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"
    small = scale_settings(10**9, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24


def test_week_filter_without_year_needs_no_job_to_plan(spark, persisted):
    from salesmart.operators import logistics

    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    df = logistics.l5_shipping_delay(persisted, Period(semaine_iso=1))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert {r.semaine_iso for r in df.collect()} == {1}


def test_fact_files_hold_narrow_runs_of_dates(spark, tmp_root):
    """A month's filter skips most row groups of its year, by their bounds."""
    import glob

    import pyarrow.parquet as pq

    from mart_samples import SF0001
    from salesmart.plans.mart import build_mart, write_table
    from salesmart.sources.testdata import load_oltp

    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_table("fait_livraisons", build_mart(load_oltp(spark, SF0001)).fait_livraisons.repartition(6), tmp_root)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = glob.glob(f"{tmp_root}/fait_livraisons/annee=*/*.parquet")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(files) <= n + len(glob.glob(f"{tmp_root}/fait_livraisons/annee=*"))
    bounds = []
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index("datecom_key")
        bounds += [(s.min, s.max) for s in (meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups))]
    year = max({lo // 10000 for lo, _ in bounds}, key=lambda y: sum(lo // 10000 == y for lo, _ in bounds))
    mine = [b for b in bounds if b[0] // 10000 == year]
    month = (year * 10000 + 601, year * 10000 + 630)
    assert len(mine) > 1 and sum(lo <= month[1] and hi >= month[0] for lo, hi in mine) < len(mine)
