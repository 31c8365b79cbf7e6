"""Report semantics on hand-made edge rows (F*, L*, views, report layer)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from salesmart import Period
from salesmart.operators import finance, logistics, report_layer
from salesmart.schema import DETAIL_PREFIX, GAP_EARLY, GAP_LATE, GAP_ON_TIME, SENTINEL, UNKNOWN_LABEL


def test_f2_groups_by_product_name_with_category_subtotals(edge_mart):
    rows = [r for r in finance.f2_revenue_product(edge_mart).collect() if (r.annee, r.mois) == (2016, 1)]
    the = [r for r in rows if r.nomprod == "Thé"]
    assert len(the) == 1 and the[0].categorie == DETAIL_PREFIX + "Boissons"
    assert the[0].ca_net == pytest.approx(42.75 + 9.00 + 1.00 + 1.00)
    sub = [r for r in rows if r.nomprod is None and r.categorie == "Boissons"][0]
    assert sub.ca_net == pytest.approx(sum(r.ca_net for r in rows if r.categorie == DETAIL_PREFIX + "Boissons"))


def test_vf2_keeps_products_apart(edge_mart):
    rows = finance.vf2_revenue_product(edge_mart).filter(F.col("nomprod") == "Thé").collect()
    assert sorted(r.refprod for r in rows) == [10, 11]


def test_f4_label_applied_after_grouping(edge_mart):
    rows = [r for r in finance.f4_revenue_carrier(edge_mart).collect() if (r.annee, r.mois) == (2016, 1)]
    labelled = [r for r in rows if r.transporteur == UNKNOWN_LABEL]
    assert len(labelled) == 2          # the NULL carrier and the carrier really named so
    assert sorted(r.ca_net for r in labelled) == pytest.approx([2.00, 10.00])


def test_f5_distinct_orders(edge_mart):
    rows = finance.f5_orders_employee_customer(edge_mart, grain="annee").collect()
    r = [x for x in rows if x.annee == 2016 and x.noemp == 1 and x.codecli == "C1"][0]
    assert r.nb_commandes == 2          # orders 100 and 102 (4 lines)
    assert r.remise_moyenne == pytest.approx(0.01)      # 5 lines: 0.05, 0, 0, 0, 0


def test_f8_share_of_period_total(edge_mart):
    rows = finance.f8_top_customers_period(edge_mart).collect()
    jan = [r for r in rows if (r.annee, r.mois) == (2016, 1)]
    assert sum(r.ca_pct_du_total for r in jan) == pytest.approx(100.0, abs=0.02)
    assert all(r.ca_total == pytest.approx(sum(x.ca_net for x in jan)) for r in jan)


def test_vf8_top_customers(edge_mart):
    rows = finance.vf8_top_customers(edge_mart).collect()
    assert rows[0].codecli == "C1" and rows[0].ca_net >= rows[-1].ca_net
    assert sum(r.pct_total for r in rows) == pytest.approx(100.0, abs=0.02)


def test_l1_signed_gap_nulls_last(edge_mart):
    rows = logistics.l1_date_gaps(edge_mart).collect()
    assert rows[0].nocom == 100 and rows[0].ecart_obj_envoi_jours == -5 and rows[0].ecart_abs_jours == 5
    assert rows[1].nocom == 101 and rows[1].ecart_obj_envoi_jours == 3
    assert all(r.ecart_abs_jours is None for r in rows[3:])
    r107 = [r for r in rows if r.nocom == 107][0]
    assert r107.date_envoi is None          # ship date outside the calendar


def test_l2_and_vl2_reorder(edge_mart, edge_oltp):
    assert [r.refprod for r in logistics.l2_reorder(edge_mart).collect()] == [10]
    assert [(r.refprod, r.stock_dispo) for r in logistics.vl2_reorder(edge_oltp).collect()] == [(10, 5)]


def test_l3_labels_each_missing_level(edge_mart):
    rows = logistics.l3_qty_zone(edge_mart, grain="mois").collect()
    r = [x for x in rows if x.paysliv == "Belgique" and x.annee == 2014][0]
    assert (r.regionliv, r.villeliv, r.qte_livree) == ("unknown", UNKNOWN_LABEL, 5)


def test_l4_same_country(edge_mart):
    got = {tuple(r) for r in logistics.l4_same_country_supplier(edge_mart).collect()}
    assert got == {(100, "France", "France", "Four A"), (102, "France", "France", "Four A"),
                   (106, "France", "France", "Four A")}


def test_vl4_null_safe_region(edge_oltp):
    got = {tuple(r) for r in logistics.vl4_same_region_supplier(edge_oltp).collect()}
    assert got == {(100, "Nord", 1, "Four A", "Nord"), (102, SENTINEL, 2, "Four B", SENTINEL),
                   (106, "Nord", 1, "Four A", "Nord")}


def test_vl5_late_rate(edge_mart):
    got = {r.nomtran: (r.nb_cmd, r.nb_retard, r.taux_retard_pct)
           for r in logistics.vl5_late_rate_carrier(edge_mart).collect()}
    assert got == {"Speedy": (4, 0, 0.0), None: (2, 1, 50.0), "Non renseigné": (1, 0, 0.0)}


def test_v_carrier_stats_averages_ignore_nulls(edge_mart):
    got = {r.nomtran: r for r in logistics.v_carrier_stats(edge_mart).collect()}
    assert got[None].nb_commandes == 2 and got[None].retard_moyen == pytest.approx(3.0)


def test_period_filter_and_grain(edge_mart):
    rows = finance.f2_revenue_product(edge_mart, Period(annee=2016, mois=1)).collect()
    assert rows and {(r.annee, r.mois) for r in rows} == {(2016, 1)}
    rows = finance.f3_revenue_country(edge_mart, grain="annee").collect()
    assert set(rows[0].asDict()) == {"annee", "paysliv", "ca_net", "port_total_alloue"}
    with pytest.raises(ValueError):
        finance.f3_revenue_country(edge_mart, grain="semaine")
    wk = logistics.l5_shipping_delay(edge_mart, Period(semaine_iso=53)).collect()
    assert {r.semaine_iso for r in wk} == {53}


def test_slicer(edge_mart):
    l3 = logistics.v_delays(edge_mart)
    assert report_layer.slicer(l3, {"nomtran": ["Speedy"]}).count() == 2
    assert report_layer.slicer(l3, {"nomtran": ["Speedy"]}, include_null=["nomtran"]).count() == 3
    assert report_layer.slicer(l3, {"nomtran": []}).count() == l3.count()


def test_kpis(edge_mart):
    k = report_layer.kpi_finance(edge_mart).collect()[0]
    assert (k.nb_commandes, k.nb_lignes, k.qte_totale) == (5, 8, 23)
    assert report_layer.kpi_shipments(edge_mart).collect()[0].nb_expeditions == 7
    assert report_layer.kpi_shipments(edge_mart, selections={"paysliv": ["France"]}).collect()[0][0] == 3


def test_top_n_per_group_and_overall(edge_mart):
    top = report_layer.top_customers_per_year(edge_mart, n=1).collect()
    assert {r.annee: r.codecli for r in top} == {2014: "C2", 2016: "C1"}
    base = finance.vf5_avg_discount_customer(edge_mart)
    assert report_layer.top_n(base, 2, [F.col("ca_net").desc(), "codecli"]).count() == 2


def test_role_date_and_gap_direction(edge_mart):
    env = report_layer.role_date_report(edge_mart, role="env").collect()
    assert sum(r.nb_expeditions for r in env) == 4          # 101..105 shipped inside the calendar
    with pytest.raises(ValueError):
        report_layer.role_date_report(edge_mart, role="xyz")
    got = {(r.transporteur, r.sens): r.nb_commandes for r in report_layer.gap_direction(edge_mart).collect()}
    assert got[("Speedy", GAP_EARLY)] == 1 and got[(UNKNOWN_LABEL, GAP_LATE)] == 1
    assert got[("Speedy", GAP_ON_TIME)] == 1


def test_price_quantity_and_discount_distribution(edge_mart):
    pq = {r.refprod: r for r in report_layer.price_vs_quantity(edge_mart).collect()}
    assert pq[10].qte_totale == 13 and pq[10].prix_moyen == pytest.approx((4.5 + 4.5 + 1.0) / 3)
    dd = {r.remise: r.nb_lignes for r in report_layer.discount_distribution(edge_mart).collect()}
    assert dd == {0.0: 5, 0.05: 1, 0.1: 1, 1.0: 1}
