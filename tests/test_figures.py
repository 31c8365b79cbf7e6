"""Q1, Q2 and Q6 from the figures of the load itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from mart_samples import D, SF0001, edge_rows, make_oltp
from salesmart.operators.quality import dq_not_null, dq_order_count, dq_revenue_reconciliation
from salesmart.plans.mart import load_checks, load_figures, refresh
from salesmart.sources.testdata import load_oltp


def figures(spark, root):
    return {(r.table_name, r.figure): r.value for r in load_figures(spark, root).collect()}


def assert_as_scanned(spark, root, mart):
    got = figures(spark, root)
    nulls = {(r.table_name, r.column_name): r.n_nulls for r in dq_not_null(mart).collect()}
    assert {k: v for k, v in got.items() if k[1] not in ("n_rows", "ca_dw")} == nulls
    assert {k[0]: v for k, v in got.items() if k[1] == "n_rows"} == {name: df.count() for name, df in mart.tables().items()}
    assert got["fait_ventes", "ca_dw"] == (mart.fait_ventes.agg(F.sum("montant_net")).first()[0] or 0)


def test_load_counts_what_a_scan_counts(spark, tmp_root):
    assert load_figures(spark, tmp_root) is None
    mart = refresh(spark, load_oltp(spark, SF0001), tmp_root)
    assert_as_scanned(spark, tmp_root, mart)


def test_load_counts_the_nulls_of_edge_rows(spark, edge_oltp, tmp_root):
    mart = refresh(spark, edge_oltp, tmp_root)
    assert_as_scanned(spark, tmp_root, mart)
    assert any(v for k, v in figures(spark, tmp_root).items() if k[1] == "port_alloc")


def test_load_of_nothing(spark, tmp_root):
    mart = refresh(spark, make_oltp(spark), tmp_root)
    assert_as_scanned(spark, tmp_root, mart)


def test_incremental_load_counts_the_years_it_wrote(spark, edge_oltp, tmp_root):
    refresh(spark, edge_oltp, tmp_root)
    rows = edge_rows()
    rows["detailcommande"].append(dict(nocom=106, refprod=10, prixunit=D("2.00"), qte=3, remise=D("0.00")))
    mart = refresh(spark, make_oltp(spark, **rows), tmp_root, incremental=True)
    got, written = figures(spark, tmp_root), mart.fait_ventes.where("annee = 2016")
    assert got["fait_ventes", "n_rows"] == written.count()
    assert got["fait_ventes", "ca_dw"] == written.agg(F.sum("montant_net")).first()[0]
    refresh(spark, make_oltp(spark, **rows), tmp_root, incremental=True)
    assert not [k for k in figures(spark, tmp_root) if k[0].startswith("fait_")]


def assert_checks(spark, root, oltp, mart):
    got = load_checks(spark, root)
    assert got["dq_revenue_reconciliation"].collect() == dq_revenue_reconciliation(oltp, mart).collect()
    assert got["dq_order_count"].collect() == dq_order_count(oltp, mart).collect()


def test_checks_of_a_load_are_the_registered_ones(spark, tmp_root):
    assert load_checks(spark, tmp_root) is None
    oltp = load_oltp(spark, SF0001)
    assert_checks(spark, tmp_root, oltp, refresh(spark, oltp, tmp_root))
    read = "".join(df._jdf.queryExecution().executedPlan().toString() for df in load_checks(spark, tmp_root).values())
    assert "_years" in read and "fait_" not in read and "detailcommande" not in read


def test_checks_cover_kept_and_written_years(spark, edge_oltp, tmp_root):
    assert_checks(spark, tmp_root, edge_oltp, refresh(spark, edge_oltp, tmp_root))
    rows = edge_rows()
    rows["detailcommande"].append(dict(nocom=106, refprod=10, prixunit=D("2.00"), qte=3, remise=D("0.15")))
    rows["detailcommande"].append(dict(nocom=99999, refprod=10, prixunit=D("2.00"), qte=3, remise=D("0.00")))  # of no order
    oltp = make_oltp(spark, **rows)
    for _ in range(2):  # one year is written, then none
        assert_checks(spark, tmp_root, oltp, refresh(spark, oltp, tmp_root, incremental=True))
    rows["detailcommande"].append(dict(nocom=106, refprod=11, prixunit=D("7.00"), qte=1, remise=D("0.00")))
    oltp = make_oltp(spark, **rows)
    named = spark.createDataFrame([(106,)], "nocom long")
    assert_checks(spark, tmp_root, oltp, refresh(spark, oltp, tmp_root, incremental=True, changed=named))


def test_checks_of_nothing(spark, tmp_root):
    oltp = make_oltp(spark)
    assert_checks(spark, tmp_root, oltp, refresh(spark, oltp, tmp_root))
