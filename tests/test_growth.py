"""What the line-grain reports shuffle and hold: seen in plans without broadcasts, the plans of large tables."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mart_samples import SF0001
from salesmart.operators import finance
from salesmart.operators.report_layer import slice_mart
from salesmart.plans.mart import build_mart
from salesmart.plans.model import Mart
from salesmart.schema import DETAIL_PREFIX
from salesmart.sources.testdata import load_oltp
from test_skew import conf

LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def rows(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def exchange_keys(spark, report) -> list[str]:
    """The first key of each exchange of the report."""
    with conf(spark, LARGE):
        plan = report(build_mart(load_oltp(spark, SF0001)))._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (?:hash|range)partitioning\((\w+)#", plan)


def check_lookups(spark, edge_oltp, report) -> None:
    built = build_mart(edge_oltp)
    by_key = Mart(**built.tables())
    assert rows(report(built)) == rows(report(by_key)) and report(built).columns == report(by_key).columns
    sliced = slice_mart(built, {"codecli": ["C1"]})  # its facts are not those it was built with
    assert rows(report(sliced)) == rows(report(slice_mart(by_key, {"codecli": ["C1"]}))) != rows(report(built))
    keys = exchange_keys(spark, report)
    assert not {"client_key", "produit_key"} & set(keys), keys  # members came along, lines meet no dimension again


def test_f1_looks_members_up_once(spark, edge_oltp):
    check_lookups(spark, edge_oltp, finance.f1_discounts)


def test_vf1_looks_members_up_once(spark, edge_oltp):
    check_lookups(spark, edge_oltp, finance.vf1_discounts)


def test_v_discounts_agg_looks_members_up_once(spark, edge_oltp):
    check_lookups(spark, edge_oltp, finance.v_discounts_agg)


@pytest.mark.parametrize("report, group, sums", [
    (finance.f6_revenue_supplier_product, "fournisseur_societe", ["qte", "montant_net"]),
    (finance.f2_revenue_product, "nomcateg", ["montant_net"]),
])
def test_subtotals_hold_no_sorted_lines(spark, report, group, sums):
    """a task neither sorts its lines to meet the products nor holds subtotals next to the lines' groups."""
    with conf(spark, LARGE):
        mart = build_mart(load_oltp(spark, SF0001))
        df = report(mart)
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = rows(df)
    above, _, below = plan.partition("ShuffledHashJoin [produit_key")
    assert below and "Expand" in above
    assert "keys=[annee" in above[above.index("Expand"):]  # summed per item before the Expand
    lines = mart.fait_ventes.join(mart.dim_produit, "produit_key").join(mart.dim_temps.drop("annee"), "date_key")
    P = ["annee", "trimestre", "mois"]
    totals = [F.sum(sums[0])] if len(sums) == 2 else []
    totals.append(F.sum("montant_net").cast("double"))
    detail = lines.groupBy(*P, group, "nomprod").agg(*totals).select(*P, F.concat(F.lit(DETAIL_PREFIX), group), "nomprod", "*")
    total = lines.groupBy(*P, group).agg(*totals).select(*P, group, F.lit(None), "*")
    n = len(totals)
    expected = Counter(tuple(r)[:5] + tuple(r)[-n:] for df in (detail, total) for r in df.collect())
    assert got == expected
