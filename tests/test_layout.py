"""The written facts spread a hot order over tasks, and scans for a client, a product or an order skip row groups."""

from __future__ import annotations

import glob
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from mart_samples import SF0001
from salesmart.functions.clustering import interleaved
from salesmart.plans.mart import load_mart
from salesmart.sources.testdata import load_oltp


def rows_read(df) -> int:
    """Rows that the scan of a filter hands on: those of the row groups it did not skip."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def written(spark):
    """A mart in which one order has a third of the lines, written by 24 tasks."""
    import tempfile

    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    root = tempfile.mkdtemp(prefix="salesmart-test-", dir="/tmp")
    try:
        o = load_oltp(spark, SF0001)
        hot = o.commande.agg(F.min("nocom")).scalar()
        lines = o.detailcommande.withColumn("nocom", F.when(F.col("refprod") % 3 == 0, hot).otherwise(F.col("nocom")))
        return load_mart(replace(o, detailcommande=lines), root), root
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_hot_order_is_written_by_several_tasks(written):
    mart, root = written
    hot = mart.fait_ventes.groupBy("nocom").count().orderBy(F.desc("count")).first()
    total = mart.fait_ventes.count()
    assert hot["count"] > total / 4
    by_task: dict[str, int] = {}
    for path in glob.glob(f"{root}/fait_ventes/annee=*/part-*.parquet"):
        n = pq.read_table(path, columns=["nocom"], partitioning=None)["nocom"].to_pylist().count(hot["nocom"])
        task = path.split("part-")[1][:5]
        by_task[task] = by_task.get(task, 0) + n
    assert sum(n > 0 for n in by_task.values()) >= 4 and max(by_task.values()) < total / 8


def test_scans_skip_row_groups(written):
    mart, _ = written
    ventes = mart.fait_ventes.select("nocom", "client_key", "produit_key", "qte")
    total = ventes.count()
    one = mart.fait_ventes.groupBy("nocom", "client_key", "produit_key").count().orderBy("count", F.desc("nocom")).first()
    order = ventes.where(F.col("nocom") == one["nocom"])
    client = ventes.where(F.col("client_key") == F.lit(bytes(one["client_key"])))
    product = ventes.where(F.col("produit_key") == one["produit_key"])
    assert rows_read(order) < total / 4 and not order.isEmpty()
    assert rows_read(client) < total / 2 and not client.isEmpty()
    assert rows_read(product) < total / 1.2 and not product.isEmpty()


def test_bits_interleave_from_the_highest(spark):
    df = spark.createDataFrame([(a, b) for a in (0, 1, 128, 255) for b in (0, 1, 129, 255)] + [(None, 3)], "a int, b int")
    for r in df.select("a", "b", interleaved(F.col("a"), F.col("b")).alias("z")).collect():
        bits = lambda x: format(x or 0, "08b")
        assert r.z == int("".join(x + y for x, y in zip(bits(r.a), bits(r.b), strict=True)), 2)
