"""Logistics reports: business queries L1–L5 (by period incl. ISO week) and views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import clean, pct_round2, to_money
from salesmart.operators.finance import _label, deliveries, sales
from salesmart.plans.model import Mart, Oltp
from salesmart.plans.period import Period, logistics_grain
from salesmart.schema import SENTINEL

GEO3 = ("paysliv", "regionliv", "villeliv")


# --------------------------------------------------------------------- L1
def l1_date_gaps(mart: Mart, period: Period | None = None, limit: int = 50) -> DataFrame:
    """L1: orders with the largest |ship − target| gap (NULL gaps last).

    The top-k runs on the fact + calendar columns only (a per-task top-k,
    then a merge of k rows per task); carrier and address are attached to
    the ``limit`` rows that remain.
    """
    P = ["annee", "trimestre", "mois", "semaine_iso"]
    cal = mart.dim_temps
    fl = deliveries(mart, period, P + ["date_jour"]).withColumnRenamed("date_jour", "date_commande")
    fl = (fl.join(cal.select(F.col("date_key").alias("dateenv_key"), F.col("date_jour").alias("date_envoi")),
                  "dateenv_key", "left")
          .join(cal.select(F.col("date_key").alias("dateobj_key"), F.col("date_jour").alias("date_objectif")),
                "dateobj_key", "left"))
    gap = F.datediff("date_envoi", "date_objectif")
    top = (fl.select(*P, "nocom", "date_commande", "date_envoi", "date_objectif", "transporteur_key", "geo_key",
                     gap.alias("ecart_obj_envoi_jours"), F.abs(gap).alias("ecart_abs_jours"))
           .orderBy(F.col("ecart_abs_jours").desc_nulls_last(), "nocom").limit(limit))
    out = (top.join(mart.dim_transporteur.select("transporteur_key", "nomtran"), "transporteur_key", "left")
           .join(mart.dim_geo.select("geo_key", *GEO3), "geo_key", "left"))
    return out.select(*P, "nocom", "date_commande", "date_envoi", "date_objectif", "ecart_obj_envoi_jours",
                      "ecart_abs_jours", "nomtran", *GEO3
                      ).orderBy(F.col("ecart_abs_jours").desc_nulls_last(), "nocom")


# --------------------------------------------------------------------- L2
def l2_reorder(mart: Mart) -> DataFrame:
    """L2: products whose available stock is below the reorder level."""
    p = mart.dim_produit
    dispo = F.col("unitesstock") - F.col("unitescom")
    return (p.filter(F.col("unitesstock").isNotNull() & F.col("unitescom").isNotNull()
                     & F.col("niveaureap").isNotNull() & (dispo < F.col("niveaureap")))
            .select("refprod", "nomprod", "nomcateg", "fournisseur_societe", "unitesstock", "unitescom",
                    "niveaureap", dispo.alias("stock_dispo"))
            .orderBy(F.col("stock_dispo").asc_nulls_last(), F.col("niveaureap").desc_nulls_first(), "refprod"))


# --------------------------------------------------------------------- L3
def l3_qty_zone(mart: Mart, period: Period | None = None, grain: str = "semaine") -> DataFrame:
    """L3: quantities delivered per country / region / city."""
    P = logistics_grain(grain)
    g = (sales(mart, period, P).join(mart.dim_geo.select("geo_key", *GEO3), "geo_key", "left")
         .groupBy(*P, *GEO3).agg(F.sum("qte").alias("qte_livree")))
    return g.select(*P, *[_label(c).alias(c) for c in GEO3], "qte_livree"
                    ).orderBy(*P, F.col("qte_livree").desc_nulls_first())


# --------------------------------------------------------------------- L4
def l4_same_country_supplier(mart: Mart) -> DataFrame:
    """L4: orders holding a product whose supplier is in the delivery country.

    Lines meet their product (supplier country) and become distinct (order,
    country, supplier) rows before they meet their order, so an order with
    very many lines brings one row per supplier to the join, and partial
    aggregates reduce it in every task. The country equality is a join key,
    so no pair is built only to be filtered.
    """
    sup = (mart.fait_ventes.select("nocom", "produit_key")
           .join(mart.dim_produit.filter(F.col("fournisseur_pays").isNotNull())
                 .select("produit_key", F.col("fournisseur_pays").alias("paysliv"), "fournisseur_societe"),
                 "produit_key")
           .select("nocom", "paysliv", "fournisseur_societe").distinct())
    orders = (mart.fait_livraisons.select("nocom", "geo_key")
              .join(mart.dim_geo.select("geo_key", "paysliv").filter(F.col("paysliv").isNotNull()), "geo_key"))
    out = sup.join(orders, ["nocom", "paysliv"]).select(
        "nocom", "paysliv", F.col("paysliv").alias("fournisseur_pays"), "fournisseur_societe")
    return out.distinct().orderBy("nocom")


# --------------------------------------------------------------------- L5
def l5_shipping_delay(mart: Mart, period: Period | None = None, grain: str = "semaine") -> DataFrame:
    """Shipments, average shipping delay and freight per carrier name."""
    P = logistics_grain(grain)
    g = (deliveries(mart, period, P)
         .join(mart.dim_transporteur.select("transporteur_key", "nomtran"), "transporteur_key", "left")
         .groupBy(*P, "nomtran").agg(
             F.count(F.lit(1)).alias("n"), F.sum("delai_envoi_jours").alias("sd"),
             F.count("delai_envoi_jours").alias("cd"), F.sum("port").alias("sp")))
    return g.select(
        *P, _label("nomtran").alias("transporteur"),
        F.col("n").alias("nb_expeditions"),
        (F.col("sd").cast("double") / F.nullif(F.col("cd"), F.lit(0))).alias("delai_envoi_moyen_jours"),
        to_money(F.col("sp")).alias("port_total"),
    ).orderBy(*P, F.col("delai_envoi_moyen_jours").desc_nulls_first())


# ----------------------------------------------------------- views, file 1
def v_delays(mart: Mart) -> DataFrame:
    """Orders with a known lateness, carrier and address, latest first."""
    fl = mart.fait_livraisons.filter(F.col("retard_jours").isNotNull())
    out = (fl.join(mart.dim_transporteur.select("transporteur_key", "notran", "nomtran"), "transporteur_key", "left")
           .join(mart.dim_geo.select("geo_key", *GEO3), "geo_key", "left"))
    return out.select("nocom", "notran", "nomtran", *GEO3, "retard_jours", "delai_envoi_jours",
                      to_money(F.col("port")).alias("port")).orderBy(F.col("retard_jours").desc_nulls_first(), "nocom")


def v_qty_zone_all(mart: Mart) -> DataFrame:
    """Quantity and net revenue per country / region / city (NULLs kept)."""
    g = (mart.fait_ventes.join(mart.dim_geo.select("geo_key", *GEO3), "geo_key", "left")
         .groupBy(*GEO3).agg(F.sum("qte").alias("qte_totale"), F.sum("montant_net").alias("ca")))
    return g.select(*GEO3, "qte_totale", to_money(F.col("ca")).alias("ca_net"))


def v_carrier_stats(mart: Mart) -> DataFrame:
    """Orders, average delay / lateness (NULLs ignored) and freight per carrier."""
    g = (mart.fait_livraisons
         .join(mart.dim_transporteur.select("transporteur_key", "notran", "nomtran"), "transporteur_key", "left")
         .groupBy("notran", "nomtran").agg(
             F.count(F.lit(1)).alias("n"),
             F.sum("delai_envoi_jours").alias("sd"), F.count("delai_envoi_jours").alias("cd"),
             F.sum("retard_jours").alias("sr"), F.count("retard_jours").alias("cr"),
             F.sum("port").alias("sp")))
    return g.select(
        "notran", "nomtran", F.col("n").alias("nb_commandes"),
        (F.col("sd").cast("double") / F.nullif(F.col("cd"), F.lit(0))).alias("delai_moyen_envoi"),
        (F.col("sr").cast("double") / F.nullif(F.col("cr"), F.lit(0))).alias("retard_moyen"),
        to_money(F.col("sp")).alias("port_total"))


# ----------------------------------------------------------- views, file 2
def vl1_largest_delays(mart: Mart) -> DataFrame:
    return v_delays(mart).drop("notran")


def vl2_reorder(oltp: Oltp) -> DataFrame:
    """Reorder list straight from the source product table (NULL → excluded)."""
    dispo = F.col("unitesstock") - F.col("unitescom")
    return (oltp.produit.filter(dispo < F.col("niveaureap"))
            .select("refprod", "nomprod", "unitesstock", "unitescom", "niveaureap", dispo.alias("stock_dispo"))
            .orderBy(F.col("stock_dispo").asc_nulls_last(), "refprod"))


def vl3_qty_zone(mart: Mart) -> DataFrame:
    return v_qty_zone_all(mart).orderBy(F.col("qte_totale").desc_nulls_first())


def vl4_same_region_supplier(oltp: Oltp, sentinels=(SENTINEL,)) -> DataFrame:
    """Orders holding a product whose supplier is in the delivery region.

    Regions are compared after cleaning and NULL-safely, so an unknown
    region matches an unknown region; the output keeps the raw values.
    The comparison is a (NULL-safe) join key next to ``nocom``.
    """
    s = tuple(sentinels)
    # product → supplier first (a dimension-sized join), so the lines are
    # shuffled once, on the product key
    prod_sup = oltp.produit.select("refprod", "nofour").join(
        oltp.fournisseur.select("nofour", F.col("societe").alias("fournisseur"),
                                F.col("region").alias("region_fournisseur")), "nofour")
    sup = (oltp.detailcommande.select("nocom", "refprod").join(prod_sup, "refprod")
           .select("nocom", "nofour", "fournisseur", "region_fournisseur").distinct()
           .withColumn("_rf", clean("region_fournisseur", s)))
    cmd = oltp.commande.select(F.col("nocom").alias("_nocom"), "regionliv").withColumn("_rc", clean("regionliv", s))
    # ``sup`` is distinct and an order has one header (source key): the
    # join output is already DISTINCT.
    out = sup.join(cmd, (sup.nocom == cmd._nocom) & sup._rf.eqNullSafe(cmd._rc))
    return out.select("nocom", "regionliv", "nofour", "fournisseur", "region_fournisseur")


def vl5_late_rate_carrier(mart: Mart) -> DataFrame:
    """Share of late orders per carrier; orders without a known lateness
    count in the denominator."""
    late = F.when(F.col("retard_jours") > 0, 1).otherwise(0)
    g = (mart.fait_livraisons
         .join(mart.dim_transporteur.select("transporteur_key", "notran", "nomtran"), "transporteur_key", "left")
         .groupBy("notran", "nomtran").agg(F.count(F.lit(1)).alias("nb_cmd"),
                                           F.sum(late).cast("bigint").alias("nb_retard")))
    return g.select("notran", "nomtran", "nb_cmd", "nb_retard",
                    pct_round2(F.col("nb_retard"), F.col("nb_cmd")).alias("taux_retard_pct")
                    ).orderBy(F.col("taux_retard_pct").desc_nulls_first())

