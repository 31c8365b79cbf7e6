"""A hot key holding a third of the rows: results unchanged, work split.

The skewed data is derived from the given tables by Spark: a third of
the order lines are moved onto one order, and a third of the orders onto
one customer. Broadcasts are switched off so the shuffled plans are the
ones exercised, and AQE's skew-join thresholds are lowered to the size
of this small data.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mart_samples import SF0001
from salesmart.operators import finance
from salesmart.operators import facts
from salesmart.plans.mart import build_mart, load_mart
from salesmart.sources.testdata import load_oltp

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture(scope="module")
def skewed(spark):
    o = load_oltp(spark, SF0001)
    hot_order = o.commande.agg(F.min("nocom")).scalar()
    hot_customer = o.client.agg(F.min("codecli")).scalar()
    # the test files are one Parquet row group each (one scan task); AQE splits
    # a skewed partition at map-output boundaries, so spread the lines over
    # several map tasks, as many input files would at scale
    lines = o.detailcommande.withColumn(
        "nocom", F.when(F.col("refprod") % 3 == 0, hot_order).otherwise(F.col("nocom"))).repartition(8)
    orders = o.commande.withColumn(
        "codecli", F.when(F.col("nocom") % 3 == 0, hot_customer).otherwise(F.col("codecli")))
    return replace(o, detailcommande=lines, commande=orders)


def _totals(mart):
    return mart.fait_ventes.agg(F.count(F.lit(1)), F.sum("montant_net"), F.sum("port_alloc"),
                                F.countDistinct("nocom")).collect()[0]


def test_hot_order_lines_are_split_and_results_unchanged(spark, skewed, tmp_root):
    expected = _totals(build_mart(skewed))
    with conf(spark, SKEW_CONF):
        mart = load_mart(skewed, tmp_root)          # staged load (the production path)
        got = _totals(mart)
        # the sales fact exactly as the staged load builds it, from the written order fact
        fv = facts.fact_sales(skewed.detailcommande, mart.fait_livraisons, mart.dim_produit)
        fv.collect()                                # runs this DataFrame's own adaptive plan
        plan = fv._jdf.queryExecution().executedPlan().toString()
    assert got == expected
    assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan
    hot = mart.fait_ventes.groupBy("nocom").count().orderBy(F.desc("count")).first()
    assert hot["count"] > mart.fait_ventes.count() / 4


def test_reports_on_hot_customer_match_broadcast_plans(spark, skewed):
    mart = build_mart(skewed)
    expected = {tuple(r) for r in finance.vf5_avg_discount_customer(mart).collect()}
    expected_f8 = [tuple(r) for r in finance.f8_top_customers_period(mart).collect()]
    with conf(spark, SKEW_CONF):
        mart = build_mart(skewed)
        got = {tuple(r) for r in finance.vf5_avg_discount_customer(mart).collect()}
        got_f8 = [tuple(r) for r in finance.f8_top_customers_period(mart).collect()]
    assert got == expected and got_f8 == expected_f8


def test_hot_order_is_reduced_before_the_joins(spark, skewed):
    """L4 and Q7: what meets the orders is a row per supplier, or one, of the hot order, not its lines."""
    from salesmart.operators import logistics, quality

    mart = build_mart(skewed)
    with conf(spark, SKEW_CONF):
        l4 = logistics.l4_same_country_supplier(mart)
        got = [tuple(r) for r in l4.collect()]
        q7 = quality.dq_orders_without_lines(skewed)
        without = q7.count()
        plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (l4, q7)]
    suppliers = mart.dim_produit.select("fournisseur_societe").distinct().count()
    hot = mart.fait_ventes.groupBy("nocom").count().orderBy(F.desc("count")).first()
    per_order = (mart.fait_ventes.where(F.col("nocom") == hot["nocom"])
                 .join(mart.dim_produit, "produit_key").select("fournisseur_pays", "fournisseur_societe").distinct().count())
    assert per_order <= suppliers < hot["count"]
    assert all("Aggregate [nocom" in p for p in plans)
    assert len(got) == len(set(got)) and without == skewed.commande.join(skewed.detailcommande, "nocom", "left_anti").count()
