"""Sources S1/S3 and sinks S5/S7/S8."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from mart_samples import SF0001
from salesmart.operators import facts
from salesmart.plans.mart import read_mart, write_mart
from salesmart.plans.publish import export_csv, publish
from salesmart.sources.files import read_oltp, read_order_lines_csv, write_oltp
from salesmart.sources.testdata import load_oltp


def test_csv_order_lines_round_trip(spark, tmp_root):
    """S1 on a ';'-separated file with a header, written by another engine
    from the given tables: every line comes back with its exact values."""
    import duckdb

    path = f"{tmp_root}/lines.csv"
    duckdb.sql(f"""
        COPY (SELECT l_orderkey AS nocom, l_partkey AS refprod, CAST(l_extendedprice AS DECIMAL(10,2)) AS prixunit,
                     CAST(l_quantity AS INTEGER) AS qte, CAST(l_discount AS DECIMAL(3,2)) AS remise
              FROM read_parquet('{SF0001}/lineitem.parquet'))
        TO '{path}' (HEADER, DELIMITER ';')""")
    lines = read_order_lines_csv(spark, path)
    expected = load_oltp(spark, SF0001).detailcommande
    assert [(f.name, f.dataType) for f in lines.schema] == [(f.name, f.dataType) for f in expected.schema]
    assert lines.count() == 6000
    assert lines.exceptAll(expected).count() == 0 and expected.exceptAll(lines).count() == 0
    la = facts.line_amounts(lines).agg(F.sum("montant_net").alias("net")).collect()[0]
    assert la.net == facts.line_amounts(expected).agg(F.sum("montant_net")).collect()[0][0]


def test_csv_reader_fails_fast_on_bad_record(spark, tmp_root):
    p = f"{tmp_root}/bad.csv"
    with open(p, "w") as f:
        f.write("nocom;refprod;prixunit;qte;remise\n1;2;abc;1;0.00\n")
    with pytest.raises(Exception):
        read_order_lines_csv(spark, p).collect()


def test_oltp_round_trip(spark, edge_oltp, tmp_root):
    write_oltp(edge_oltp, f"{tmp_root}/oltp")
    back = read_oltp(spark, f"{tmp_root}/oltp")
    for name, df in edge_oltp.tables().items():
        other = getattr(back, name)
        # file sources read every column as nullable; names and types must survive
        assert [(f.name, f.dataType) for f in other.schema] == [(f.name, f.dataType) for f in df.schema]
        assert other.exceptAll(df).count() == 0 and df.exceptAll(other).count() == 0


def test_mart_write_read_publish_export(spark, edge_mart, tmp_root):
    write_mart(edge_mart, f"{tmp_root}/mart")
    back = read_mart(spark, f"{tmp_root}/mart")
    assert {d for d in os.listdir(f"{tmp_root}/mart/fait_ventes") if d.startswith("annee=")} == {
        "annee=2014", "annee=2016"}
    for name, df in edge_mart.tables().items():
        assert getattr(back, name).count() == df.count()
    publish(back, f"{tmp_root}/extract")
    assert read_mart(spark, f"{tmp_root}/extract").fait_livraisons.count() == 7
    from salesmart.operators.report_layer import kpi_finance

    export_csv(kpi_finance(back), f"{tmp_root}/kpi", single_file=True)
    parts = [p for p in os.listdir(f"{tmp_root}/kpi") if p.endswith(".csv")]
    assert len(parts) == 1
    with open(f"{tmp_root}/kpi/{parts[0]}") as fh:
        assert fh.readline().startswith("ca_net,ca_brut")


def test_literal_rows_source_casts_explicitly(spark):
    from salesmart.sources.files import from_rows

    df = from_rows(spark, "employe", [dict(noemp=1, nom="A"), dict(noemp="2", nom="B", rendcomptea="1")])
    assert [(r.noemp, r.rendcomptea) for r in df.orderBy("noemp").collect()] == [(1, None), (2, 1)]
    assert dict(df.dtypes)["noemp"] == "int"


def test_register_views(spark, edge_oltp, edge_mart):
    from salesmart.plans.views import register_views

    names = register_views(spark, edge_oltp, edge_mart, ["vf7_freight_carrier", "kpi_finance"])
    assert "fait_ventes" in names
    assert spark.sql("SELECT nb_lignes FROM kpi_finance").collect()[0][0] == 8
    assert spark.sql("SELECT COUNT(*) FROM fait_livraisons").collect()[0][0] == 7
