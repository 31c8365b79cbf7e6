"""Load operators E1–E17 on hand-made edge rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from mart_samples import day, edge_rows, make_oltp
from salesmart.functions import natural_key
from salesmart.operators import dims, facts, finance
from salesmart.operators.merge import insert_if_absent
from salesmart.plans.mart import build_mart


def _by(df, key):
    return {r[key]: r for r in df.collect()}


def test_date_bounds_use_order_ship_and_target_dates(edge_oltp):
    r = dims.date_bounds(edge_oltp.commande).collect()[0]
    assert r.dmin == day("2014-12-29")          # first order date only (ship 2014-12-01 ignored)
    assert r.dmax == day("2016-01-10")          # latest target date


def test_calendar_iso_week_with_calendar_year(edge_mart):
    cal = _by(edge_mart.dim_temps, "date_jour")
    assert len(cal) == (day("2016-01-10") - day("2014-12-29")).days + 1
    d = cal[day("2016-01-01")]
    assert (d.date_key, d.annee, d.semaine_iso, d.trimestre, d.mois, d.jour_mois) == (20160101, 2016, 53, 1, 1, 1)
    d = cal[day("2014-12-29")]
    assert (d.annee, d.semaine_iso, d.jour_semaine_iso) == (2014, 1, 1)
    assert cal[day("2016-01-03")].jour_semaine_iso == 7     # Sunday


def test_sentinel_cleaned_but_literal_unknown_kept(edge_mart):
    c2 = _by(edge_mart.dim_client, "codecli")["C2"]
    assert (c2.societe, c2.contact, c2.ville, c2.codepostal) == (None, None, None, None)
    assert c2.region == "unknown" and c2.pays == "Belgique"
    e1 = _by(edge_mart.dim_employe, "noemp")[1]
    assert e1.ville is None and e1.region == "unknown"


def test_supplier_fields_of_product_dim_cleaned(edge_mart):
    p = _by(edge_mart.dim_produit, "refprod")
    assert p[11].fournisseur_pays is None and p[11].fournisseur_societe == "Four B"
    assert p[10].nomcateg == "Boissons" and p[10].fournisseur_pays == "France"


def test_geo_dim_distinct_null_safe(edge_mart, edge_oltp):
    g = edge_mart.dim_geo.collect()
    members = {(r.paysliv, r.regionliv, r.villeliv, r.codepostalliv) for r in g}
    assert len(g) == len(members)
    assert ("Belgique", "unknown", None, None) in members
    assert ("France", None, "Lille", "59000") in members
    assert len({bytes(r.geo_key) for r in g}) == len(g)


def test_natural_keys_differ_for_different_tuples(spark):
    rows = [(None, "a"), ("a", None), ("a", "a"), (None, None), ("", ""), ("", None), ("1:a", ""), ("a-", "b"), ("a", "-b"), ("-", None), ("ab", "c"), ("a", "bc")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(natural_key("x", "y").alias("k")).distinct().count() == len(rows)


def test_fact_deliveries_rules(edge_mart):
    fl = _by(edge_mart.fait_livraisons, "nocom")
    assert set(fl) == {100, 101, 102, 103, 105, 106, 107}      # 104: unknown customer
    assert (fl[100].delai_envoi_jours, fl[100].retard_jours) == (4, 0)          # early → clamped to 0
    assert (fl[101].delai_envoi_jours, fl[101].retard_jours) == (7, 3)
    assert fl[102].retard_jours is None                                       # no target date
    assert fl[101].transporteur_key is None and fl[101].port is None
    assert (fl[100].datecom_key, fl[100].dateenv_key, fl[100].dateobj_key) == (20160101, 20160105, 20160110)
    assert fl[102].dateobj_key is None
    assert fl[101].annee == 2014


def test_fact_sales_row_loss_and_amounts(edge_mart):
    rows = edge_mart.fait_ventes.collect()
    assert sorted(r.nocom for r in rows) == [100, 100, 100, 101, 102, 102, 105, 106]
    assert 77 not in {r.produit_key for r in rows}          # unknown product dropped
    first = [r for r in rows if r.nocom == 100 and r.qte == 10][0]
    assert first.montant_brut == Decimal("45.00") and first.montant_net == Decimal("42.75")
    assert len({bytes(r.ventes_key) for r in rows}) == len(rows)


def test_freight_allocation(edge_mart):
    rows = edge_mart.fait_ventes.collect()
    o100 = sorted(r.port_alloc for r in rows if r.nocom == 100)
    # total net of order 100 includes the unknown-product line (72.75)
    assert o100 == [Decimal("1.24"), Decimal("2.75"), Decimal("5.88")]
    assert [r.port_alloc for r in rows if r.nocom == 102] == [Decimal("0.01"), Decimal("0.01")]
    assert [r.port_alloc for r in rows if r.nocom == 105] == [Decimal("0.00")]   # net total 0
    assert [r.port_alloc for r in rows if r.nocom == 101] == [None]               # no freight


def test_line_amounts_and_totals(edge_oltp):
    la = facts.line_amounts(edge_oltp.detailcommande)
    tot = _by(facts.order_net_total(la), "nocom")
    assert tot[100].total_net == Decimal("72.7500")
    assert tot[105].total_net == Decimal("0.0000")


def test_insert_if_absent_existing_rows_win(spark):
    existing = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "k1 string, k2 string, v int")
    new = spark.createDataFrame([("a", None, 9), ("c", "y", 3), ("c", "y", 4)], "k1 string, k2 string, v int")
    out = insert_if_absent(existing, new, ["k1", "k2"], order_by=["v"]).collect()
    got = sorted((r.k1, r.k2, r.v) for r in out)
    assert got == [("a", None, 1), ("b", "x", 2), ("c", "y", 3)]
    again = insert_if_absent(spark.createDataFrame(out, existing.schema), new, ["k1", "k2"], order_by=["v"])
    assert again.count() == 3                    # idempotent


def test_first_load_collapses_repeated_members(spark):
    rows = edge_rows()
    twice = dict(rows, client=rows["client"] + [dict(r, contact="other") for r in rows["client"]])
    first, plain = build_mart(make_oltp(spark, **twice)), build_mart(make_oltp(spark, **rows))
    later = build_mart(make_oltp(spark, **twice), existing=plain)
    assert first.dim_client.count() == later.dim_client.count() == plain.dim_client.count()
    money = lambda m: sorted(tuple(r) for r in finance.vf5_avg_discount_customer(m).collect())
    assert money(first) == money(later) == money(plain)
    batch = make_oltp(spark, **twice).client.repartition(5)
    winners = [sorted(map(str, insert_if_absent(None, b, ["codecli"]).collect())) for b in (batch, batch.repartition(2))]
    assert winners[0] == winners[1]


def test_an_order_total_may_be_very_large(spark):
    rows = edge_rows()
    line = dict(nocom=100, refprod=rows["detailcommande"][0]["refprod"], prixunit=Decimal("99999999.99"), qte=1_000_000, remise=Decimal("0.00"))
    rows["detailcommande"] = [line] * 200
    mart = build_mart(make_oltp(spark, **rows))
    total = mart.fait_livraisons.where("nocom = 100").first().total_net
    assert total == Decimal("99999999.99") * 1_000_000 * 200 > 10**16
    assert mart.fait_ventes.where("nocom = 100").count() == 200
