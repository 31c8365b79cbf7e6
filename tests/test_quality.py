"""Data-quality checks Q1–Q8 on hand-made edge rows."""

from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

from mart_samples import D, edge_rows, make_oltp
from salesmart.operators import quality
from salesmart.plans.mart import build_mart


def test_q1_revenue_reconciliation(edge_oltp, edge_mart):
    r = quality.dq_revenue_reconciliation(edge_oltp, edge_mart).collect()[0]
    # source counts the header-less line, the unknown product and the unknown customer (1.00 each)
    assert r.ca_oltp == pytest.approx(r.ca_dw + 3.0)
    assert r.ecart == pytest.approx(-3.0)


def test_q2_order_count(edge_oltp, edge_mart):
    r = quality.dq_order_count(edge_oltp, edge_mart).collect()[0]
    assert (r.commandes_oltp, r.commandes_dw, r.ecart) == (8, 7, 1)


def test_q3_unique_keys_reports_repeated_lines(edge_oltp, edge_mart):
    got = {(r.table_name, r.key_name): r.n_duplicates for r in quality.dq_unique_keys(edge_oltp, edge_mart).collect()}
    assert got[("_detailcommande", "nocom,refprod")] == 1
    assert all(v == 0 for k, v in got.items() if k != ("_detailcommande", "nocom,refprod"))


def test_q3_checks_liv_key_itself(edge_oltp, edge_mart):
    """A stored fact whose liv_key repeats while its nocom does not."""
    mart = dataclasses.replace(edge_mart, fait_livraisons=edge_mart.fait_livraisons.withColumn("liv_key", F.lit(1)))
    got = {(r.table_name, r.key_name): r.n_duplicates for r in quality.dq_unique_keys(edge_oltp, mart).collect()}
    assert got[("faitLivraisons", "liv_key")] == 6 and got[("faitLivraisons", "nocom")] == 0


def test_q4_foreign_keys(edge_oltp, edge_mart):
    got = {r.fk_name: r.n_orphans for r in quality.dq_foreign_keys(edge_oltp, edge_mart).collect()}
    assert got["_commande.codecli"] == 1                 # C9
    assert got["_detailcommande.nocom"] == 1             # 999
    assert got["_detailcommande.refprod"] == 1           # 77
    assert got["faitLivraisons.dateenv_key"] == 1        # shipped before the calendar
    assert got["faitVentes.transporteur_key"] == 0 and got["faitLivraisons.geo_key"] == 0


def test_q5_line_checks_and_quarantine(spark):
    rows = edge_rows()
    rows["detailcommande"] = [
        dict(nocom=100, refprod=10, prixunit=D("1.00"), qte=0, remise=D("0.00")),
        dict(nocom=100, refprod=10, prixunit=D("1.00"), qte=-1, remise=D("-0.01")),
        dict(nocom=100, refprod=10, prixunit=D("1.00"), qte=1, remise=D("1.01")),
        dict(nocom=100, refprod=10, prixunit=D("1.00"), qte=1, remise=None),
        dict(nocom=100, refprod=10, prixunit=D("1.00"), qte=1, remise=D("0.10")),
    ]
    oltp = make_oltp(spark, **rows)
    r = quality.dq_line_checks(oltp).collect()[0]
    assert (r.n_lignes, r.n_qte_invalide, r.n_remise_hors_bornes, r.n_remise_nulle) == (5, 2, 2, 1)
    assert quality.quarantined_lines(oltp).count() == 4


def test_q6_not_null_reports_missing_freight(edge_mart):
    got = {(r.table_name, r.column_name): r.n_nulls for r in quality.dq_not_null(edge_mart).collect()}
    assert got[("fait_ventes", "port_alloc")] == 1       # order 101 has no freight
    assert sum(got.values()) == 1


def test_q7_orders_without_lines(edge_oltp):
    assert sorted(r.nocom for r in quality.dq_orders_without_lines(edge_oltp).collect()) == [103, 107]


def test_q8_freight_residual(edge_mart):
    got = {r.nocom: r.ecart for r in quality.dq_freight_residual(edge_mart).collect()}
    assert got[102] == pytest.approx(0.01)               # 0.005 + 0.005 rounded up twice
    assert got[100] == pytest.approx(-0.13)              # share of the unknown-product line is lost
    assert got[105] == pytest.approx(-7.00)              # net total 0: nothing allocated


def test_checks_on_mart_built_twice_are_stable(edge_oltp):
    a = build_mart(edge_oltp).fait_ventes.drop("ventes_key")
    b = build_mart(edge_oltp).fait_ventes.drop("ventes_key")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_orphan_orders_reach_the_checks_through_the_adapter(spark, tmp_root):
    """An order of a customer that the customer table lacks is lost by E12, and Q2 and Q4 say so."""
    import shutil

    from mart_samples import SF0001
    from salesmart.operators import quality
    from salesmart.plans.mart import build_mart
    from salesmart.sources.testdata import TABLES, load_oltp

    for t in TABLES:
        if t != "customer":
            shutil.copy(f"{SF0001}/{t}.parquet", f"{tmp_root}/{t}.parquet")
    orders = spark.read.parquet(f"{SF0001}/orders.parquet")
    some = orders.first().o_custkey
    customers = spark.read.parquet(f"{SF0001}/customer.parquet").where(f"c_custkey <> {some}")
    customers.write.mode("overwrite").parquet(f"{tmp_root}/customer.parquet")
    lost = orders.where(f"o_custkey = {some}").count()
    oltp = load_oltp(spark, tmp_root)
    mart = build_mart(oltp)
    assert quality.dq_order_count(oltp, mart).first().ecart == lost > 0
    assert {r.fk_name: r.n_orphans for r in quality.dq_foreign_keys(oltp, mart).collect()}["_commande.codecli"] == lost


def test_slicers_cut_the_facts_before_reports(spark, edge_mart):
    from salesmart.operators import logistics, report_layer

    cut = report_layer.slice_mart(edge_mart, {"paysliv": ["France"]})
    countries = {r.paysliv for r in logistics.l1_date_gaps(cut).collect()}
    assert countries == {"France"} and cut.fait_ventes.count() < edge_mart.fait_ventes.count()
    assert report_layer.slice_mart(edge_mart, {"paysliv": []}).fait_ventes.count() == edge_mart.fait_ventes.count()
    carriers = [r.nomtran for r in edge_mart.dim_transporteur.collect()]
    known = report_layer.slice_mart(edge_mart, {"nomtran": carriers})
    every = report_layer.slice_mart(edge_mart, {"nomtran": carriers}, include_null=["nomtran"])
    assert every.fait_livraisons.count() == edge_mart.fait_livraisons.count() > known.fait_livraisons.count()
    product = report_layer.slice_mart(edge_mart, {"nomcateg": ["Boissons"]})
    assert product.fait_livraisons.count() == edge_mart.fait_livraisons.count()


def test_q3_counts_rows_of_one_hash_by_their_keys(spark, edge_oltp, edge_mart, monkeypatch):
    """Where hashes clash, the keys themselves are counted; no plan expands the facts."""
    from pyspark.sql import functions as F

    want = sorted(map(tuple, quality.dq_unique_keys(edge_oltp, edge_mart).collect()))
    assert "Expand" not in quality.dq_unique_keys(edge_oltp, edge_mart)._jdf.queryExecution().optimizedPlan().toString()
    plain = quality._key_code

    def clashing(df, cols):
        code, same = plain(df, cols)
        return (code if same else F.when(code.isNotNull(), F.pmod(code, F.lit(2)))), same

    monkeypatch.setattr(quality, "_key_code", clashing)
    assert sorted(map(tuple, quality.dq_unique_keys(edge_oltp, edge_mart).collect())) == want
