"""Finance reports: business queries F1–F8 (by period) and their views.

Join first, then aggregate. A small dimension is broadcast (no shuffle);
a large one is sort-merge joined on its key, which puts every line of a
member in one task, so the partial aggregate to the report's grain is
fully effective there and only aggregated rows are shuffled after it.
Pre-aggregating the fact to (period, member) before the join would not
help: at fine grains the lines of one (period, member) are spread over
many tasks (TPC-H-like data has under one line per month × product), so
the pre-aggregate shuffles about as many rows as the fact, and a large
dimension still needs the fact on its key. Reports whose grain *is* the
member (one row per product, customer, …) aggregate by key first and
attach the attributes to one row per member — the same cost either way.
Reports of single lines take their members' attributes with ``Mart.sales_of``.
F2 and F6 hash the products instead of sorting the lines to meet them.

Money is summed in DECIMAL and returned as DOUBLE; averages are exact
``sum / count``; counts and quantities are BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions import avg_exact, share_round2, to_money
from salesmart.plans.model import Mart
from salesmart.plans.period import Period, finance_grain, with_calendar
from salesmart.schema import DETAIL_PREFIX, LEVEL_DETAIL, LEVEL_SUBTOTAL, UNKNOWN_LABEL


def sales(mart: Mart, period: Period | None, cols) -> DataFrame:
    """Sales lines with calendar columns ``cols`` of the order date."""
    return with_calendar(mart.fait_ventes, mart.dim_temps, "date_key", list(cols), period)


def deliveries(mart: Mart, period: Period | None, cols, role_key: str = "datecom_key") -> DataFrame:
    return with_calendar(mart.fait_livraisons, mart.dim_temps, role_key, list(cols), period,
                         order_date_key=(role_key == "datecom_key"))


def _desc(*cols: str) -> list[Column]:
    """DESC with NULLs first, the source system's order (Spark's default
    puts them last)."""
    return [F.col(c).desc_nulls_first() for c in cols]


def _label(col: str) -> Column:
    """NULL member → fixed label, applied after grouping (a real member
    with the same text stays a separate row)."""
    return F.coalesce(F.col(col), F.lit(UNKNOWN_LABEL))


# --------------------------------------------------------------------- F1
def f1_discounts(mart: Mart, period: Period | None = None) -> DataFrame:
    """every line with its discount, product, customer and employee,
    largest discount amount first."""
    s = mart.sales_of({"nomprod": "nomprod", "nomcateg": "nomcateg"}, {"codecli": "codecli", "client_societe": "societe"},
                      {"emp_nom": "nom", "emp_prenom": "prenom"})
    s = with_calendar(s, mart.dim_temps, "date_key", ["annee", "trimestre", "mois", "date_jour"], period)
    out = s.select(
        "annee", "trimestre", "mois", "nocom", "date_jour", "nomprod", "nomcateg", "codecli",
        "client_societe", "emp_nom", "emp_prenom", "qte",
        to_money(F.col("prixunit")).alias("prixunit"),
        F.col("remise").cast("double").alias("remise_taux"),
        to_money(F.col("montant_brut") - F.col("montant_net")).alias("remise_montant"),
        to_money(F.col("montant_net")).alias("montant_net"),
    )
    return out.orderBy(*_desc("remise_montant", "remise_taux", "montant_net"), "nocom", "nomprod")


# --------------------------------------------------------------- F2 / F6
def _subtotals(detail: DataFrame, P: tuple[str, ...], group: str, item: str,
               measures: dict[str, str], label: str) -> DataFrame:
    """Subtotal rows per ``group`` (item NULL) and detail rows per item
    (GROUPING SETS: one scan, an Expand, no union). The lines are summed
    per item first, so the Expand doubles a row per item, not the lines,
    and a task that reads lines holds no subtotals; sums of exact sums are
    the same sums."""
    items = detail.groupBy(*P, group, item).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    g = items.groupingSets([[*P, group, item], [*P, group]], *P, group, item)
    agg = g.agg(*[F.sum(n).alias(n) for n in measures], F.grouping(item).alias("_g"))
    niveau = F.when(F.col("_g") == 1, F.lit(LEVEL_SUBTOTAL)).otherwise(F.lit(LEVEL_DETAIL))
    out = agg.select(
        *P,
        F.when(niveau == LEVEL_SUBTOTAL, F.col(group))
        .otherwise(F.concat(F.lit(DETAIL_PREFIX), F.col(group))).alias(label),
        F.when(niveau == LEVEL_DETAIL, F.col(item)).alias(item),
        *[to_money(F.col(n)).alias(n) if n == "ca_net" else F.col(n) for n in measures],
        niveau.alias("_niveau"), F.col(group).alias("_group"),
    )
    return (out.orderBy(*P, F.col("_group").asc_nulls_last(), "_niveau", F.col("ca_net").desc_nulls_first())
            .drop("_niveau", "_group"))


def f2_revenue_product(mart: Mart, period: Period | None = None, grain: str = "mois") -> DataFrame:
    """net revenue per product name with a subtotal row per category."""
    P = finance_grain(grain)
    detail = (sales(mart, period, P).select(*P, "produit_key", "montant_net")
              .join(mart.dim_produit.select("produit_key", "nomcateg", "nomprod").hint("shuffle_hash"), "produit_key"))
    return _subtotals(detail, P, "nomcateg", "nomprod", {"ca_net": "montant_net"}, "categorie")


def f6_revenue_supplier_product(mart: Mart, period: Period | None = None, grain: str = "mois") -> DataFrame:
    """quantity and net revenue per supplier and product name, with a
    subtotal row per supplier."""
    P = finance_grain(grain)
    detail = (sales(mart, period, P).select(*P, "produit_key", "qte", "montant_net")
              .join(mart.dim_produit.select("produit_key", "fournisseur_societe", "nomprod").hint("shuffle_hash"), "produit_key"))
    return _subtotals(detail, P, "fournisseur_societe", "nomprod",
                      {"qte_vendue": "qte", "ca_net": "montant_net"}, "fournisseur")


# --------------------------------------------------------------------- F3
def f3_revenue_country(mart: Mart, period: Period | None = None, grain: str = "mois") -> DataFrame:
    """net revenue and allocated freight per delivery country."""
    P = finance_grain(grain)
    g = (sales(mart, period, P).join(mart.dim_geo.select("geo_key", "paysliv"), "geo_key", "left")
         .groupBy(*P, "paysliv").agg(F.sum("montant_net").alias("ca"), F.sum("port_alloc").alias("port")))
    return g.select(*P, _label("paysliv").alias("paysliv"), to_money(F.col("ca")).alias("ca_net"),
                    to_money(F.col("port")).alias("port_total_alloue")).orderBy(*P, F.col("ca_net").desc_nulls_first())


# --------------------------------------------------------------------- F4
def f4_revenue_carrier(mart: Mart, period: Period | None = None, grain: str = "mois") -> DataFrame:
    """net revenue carried per carrier name."""
    P = finance_grain(grain)
    g = (sales(mart, period, P)
         .join(mart.dim_transporteur.select("transporteur_key", "nomtran"), "transporteur_key", "left")
         .groupBy(*P, "nomtran").agg(F.sum("montant_net").alias("ca")))
    return g.select(*P, _label("nomtran").alias("transporteur"),
                    to_money(F.col("ca")).alias("ca_net")).orderBy(*P, F.col("ca_net").desc_nulls_first())


# --------------------------------------------------------------------- F5
def f5_orders_employee_customer(mart: Mart, period: Period | None = None, grain: str = "mois") -> DataFrame:
    """orders (distinct), average discount and net revenue per
    employee and customer. Employee and customer attributes are 1:1 with
    their keys, so no roll-up is needed after attaching them."""
    P = finance_grain(grain)
    base = sales(mart, period, P).groupBy(*P, "employe_key", "client_key").agg(
        F.countDistinct("nocom").alias("nb_commandes"),
        avg_exact(F.col("remise")).alias("remise_moyenne"),
        F.sum("montant_net").alias("ca"))
    out = (base.join(mart.dim_employe.select("employe_key", "noemp", F.col("nom").alias("emp_nom"),
                                             F.col("prenom").alias("emp_prenom")), "employe_key")
           .join(mart.dim_client.select("client_key", "codecli", F.col("societe").alias("client_societe")),
                 "client_key"))
    return out.select(*P, "noemp", "emp_nom", "emp_prenom", "codecli", "client_societe", "nb_commandes",
                      "remise_moyenne", to_money(F.col("ca")).alias("ca_net")
                      ).orderBy(*P, F.col("nb_commandes").desc_nulls_first(), F.col("ca_net").desc_nulls_first())


# --------------------------------------------------------------------- F7
def f7_freight_carrier(mart: Mart, period: Period | None = None, grain: str = "mois") -> DataFrame:
    """shipments, total and average freight per carrier name (order grain)."""
    P = finance_grain(grain)
    g = (deliveries(mart, period, P)
         .join(mart.dim_transporteur.select("transporteur_key", "nomtran"), "transporteur_key", "left")
         .groupBy(*P, "nomtran").agg(F.count(F.lit(1)).alias("n"), F.sum("port").alias("s"),
                                     F.count("port").alias("c")))
    return g.select(
        *P, _label("nomtran").alias("transporteur"),
        F.col("n").alias("nb_expeditions"),
        to_money(F.col("s")).alias("port_total"),
        (F.col("s").cast("double") / F.nullif(F.col("c"), F.lit(0))).alias("port_moyen"),
    ).orderBy(*P, F.col("port_total").desc_nulls_first())


# --------------------------------------------------------------------- F8
def f8_top_customers_period(mart: Mart, period: Period | None = None, grain: str = "mois",
                            limit: int = 20) -> DataFrame:
    """F8: customers by net revenue with their share of the period total;
    the first ``limit`` rows of the whole ordered output (earliest
    periods first), ties broken by customer code."""
    P = finance_grain(grain)
    base = (sales(mart, period, P).groupBy(*P, "client_key").agg(F.sum("montant_net").alias("ca"))
            .join(mart.dim_client.select("client_key", "codecli", F.col("societe").alias("client_societe")),
                  "client_key"))
    # Period totals: one row per period of the calendar, joined back on the
    # period keys (no window over a whole period, which would put it in one
    # task). Spark broadcasts them where their measured size allows it.
    tot = base.groupBy(*P).agg(F.sum("ca").alias("tot"))
    out = base.join(tot, list(P)).select(
        *P, "codecli", "client_societe",
        to_money(F.col("ca")).alias("ca_net"),
        to_money(F.col("tot")).alias("ca_total"),
        share_round2(F.col("ca"), F.col("tot")).alias("ca_pct_du_total"),
    )
    return out.orderBy(*P, F.col("ca_net").desc_nulls_first(), "codecli").limit(limit)


# ----------------------------------------------------------- views, file 1
def v_revenue_period(mart: Mart, period: Period | None = None) -> DataFrame:
    """Net / gross revenue and allocated freight per year, quarter, month, ISO week."""
    P = ["annee", "trimestre", "mois", "semaine_iso"]
    g = sales(mart, period, P).groupBy(*P).agg(
        F.sum("montant_net").alias("n"), F.sum("montant_brut").alias("b"), F.sum("port_alloc").alias("p"))
    return g.select(*P, to_money(F.col("n")).alias("ca_net"), to_money(F.col("b")).alias("ca_brut"),
                    to_money(F.col("p")).alias("port_total"))


def _by_product(mart: Mart) -> DataFrame:
    base = mart.fait_ventes.groupBy("produit_key").agg(F.sum("qte").alias("q"), F.sum("montant_net").alias("ca"))
    return base.join(mart.dim_produit, "produit_key")


def v_revenue_product_full(mart: Mart) -> DataFrame:
    """Quantity and net revenue per product with category and supplier."""
    return _by_product(mart).select(
        "refprod", "nomprod", "codecateg", "nomcateg", "nofour", "fournisseur_societe",
        F.col("q").alias("qte_totale"), to_money(F.col("ca")).alias("ca_net"))


def v_revenue_delivery_country(mart: Mart) -> DataFrame:
    """Net revenue and allocated freight per delivery country (NULL kept)."""
    g = (mart.fait_ventes.join(mart.dim_geo.select("geo_key", "paysliv"), "geo_key", "left")
         .groupBy("paysliv").agg(F.sum("montant_net").alias("ca"), F.sum("port_alloc").alias("p")))
    return g.select("paysliv", to_money(F.col("ca")).alias("ca_net"), to_money(F.col("p")).alias("port_total"))


def v_revenue_carrier(mart: Mart) -> DataFrame:
    """Net revenue and allocated freight per carrier."""
    g = (mart.fait_ventes.join(mart.dim_transporteur.select("transporteur_key", "notran", "nomtran"),
                               "transporteur_key", "left")
         .groupBy("notran", "nomtran").agg(F.sum("montant_net").alias("ca"), F.sum("port_alloc").alias("p")))
    return g.select("notran", "nomtran", to_money(F.col("ca")).alias("ca_net"),
                    to_money(F.col("p")).alias("port_total"))


def v_discounts_agg(mart: Mart) -> DataFrame:
    """Average / max discount and net revenue per customer × employee × product."""
    client, employe = ["codecli", "societe"], ["noemp", "nom", "prenom"]
    produit = ["refprod", "nomprod"]
    s = mart.sales_of(*[{c: c for c in wanted} for wanted in (produit, client, employe)])
    g = s.groupBy(*client, *employe, *produit).agg(
        avg_exact(F.col("remise")).alias("remise_moy"),
        F.max("remise").cast("double").alias("remise_max"),
        F.sum("montant_net").alias("ca"))
    return g.select(*client, *employe, *produit, "remise_moy", "remise_max", to_money(F.col("ca")).alias("ca_net"))


# ----------------------------------------------------------- views, file 2
def vf1_discounts(mart: Mart) -> DataFrame:
    """F1 view: every line, largest discount rate then net amount first."""
    s = mart.sales_of({"refprod": "refprod", "nomprod": "nomprod"}, {"codecli": "codecli", "societe_client": "societe"},
                      {"noemp": "noemp", "nom_employe": "nom", "prenom_employe": "prenom"})
    s = s.join(mart.dim_temps.select("date_key", "date_jour"), "date_key")
    out = s.select(
        "nocom", "date_jour", "refprod", "nomprod", "codecli", "societe_client", "noemp", "nom_employe",
        "prenom_employe", "qte", to_money(F.col("prixunit")).alias("prixunit"),
        F.col("remise").cast("double").alias("remise"),
        to_money(F.col("montant_brut")).alias("montant_brut"),
        to_money(F.col("montant_net")).alias("montant_net"))
    return out.orderBy(*_desc("remise", "montant_net"), "nocom", "refprod")


def vf2_revenue_product(mart: Mart) -> DataFrame:
    return _by_product(mart).select(
        "nomcateg", "refprod", "nomprod", F.col("q").alias("qte_totale"),
        to_money(F.col("ca")).alias("ca_net")).orderBy("nomcateg", F.col("ca_net").desc_nulls_first())


def vf2_revenue_category(mart: Mart) -> DataFrame:
    g = (mart.fait_ventes.join(mart.dim_produit.select("produit_key", "nomcateg"), "produit_key")
         .groupBy("nomcateg").agg(F.sum("montant_net").alias("ca")))
    return g.select("nomcateg", to_money(F.col("ca")).alias("ca_net")).orderBy(F.col("ca_net").desc_nulls_first())


def vf3_revenue_country(mart: Mart) -> DataFrame:
    return v_revenue_delivery_country(mart).orderBy(F.col("ca_net").desc_nulls_first())


def vf4_revenue_carrier(mart: Mart) -> DataFrame:
    return v_revenue_carrier(mart).orderBy(F.col("ca_net").desc_nulls_first())


def vf5_orders_employee(mart: Mart) -> DataFrame:
    base = mart.fait_ventes.groupBy("employe_key").agg(
        F.countDistinct("nocom").alias("nb_commandes"), F.sum("montant_net").alias("ca"))
    return (base.join(mart.dim_employe.select("employe_key", "noemp", "nom", "prenom"), "employe_key")
            .select("noemp", "nom", "prenom", "nb_commandes", to_money(F.col("ca")).alias("ca_net"))
            .orderBy(F.col("nb_commandes").desc_nulls_first(), F.col("ca_net").desc_nulls_first()))


def vf5_avg_discount_customer(mart: Mart) -> DataFrame:
    base = mart.fait_ventes.groupBy("client_key").agg(
        avg_exact(F.col("remise")).alias("remise_moy"), F.sum("montant_net").alias("ca"))
    return (base.join(mart.dim_client.select("client_key", "codecli", "societe"), "client_key")
            .select("codecli", "societe", "remise_moy", to_money(F.col("ca")).alias("ca_net"))
            .orderBy(F.col("remise_moy").desc_nulls_first(), "codecli"))


def vf6_supplier_product(mart: Mart) -> DataFrame:
    return _by_product(mart).select(
        "nofour", "fournisseur_societe", "refprod", "nomprod", F.col("q").alias("qte_totale"),
        to_money(F.col("ca")).alias("ca_net")).orderBy(F.col("fournisseur_societe").asc_nulls_last(),
                                                       F.col("ca_net").desc_nulls_first())


def vf7_freight_carrier(mart: Mart) -> DataFrame:
    g = (mart.fait_livraisons.join(mart.dim_transporteur.select("transporteur_key", "notran", "nomtran"),
                                   "transporteur_key", "left")
         .groupBy("notran", "nomtran").agg(F.count(F.lit(1)).alias("nb_expeditions"), F.sum("port").alias("s")))
    return g.select("notran", "nomtran", "nb_expeditions", to_money(F.col("s")).alias("port_total")
                    ).orderBy(F.col("port_total").desc_nulls_first())


def vf8_top_customers(mart: Mart, limit: int = 10) -> DataFrame:
    """Top customers by net revenue with their share of the grand total.

    The grand total is a scalar subquery (one value, computed once) — no
    cross join and no window over the whole data set.
    """
    base = (mart.fait_ventes.groupBy("client_key").agg(F.sum("montant_net").alias("ca"))
            .join(mart.dim_client.select("client_key", "codecli", "societe"), "client_key"))
    total = base.select(F.sum("ca")).scalar()
    return base.select(
        "codecli", "societe", to_money(F.col("ca")).alias("ca_net"),
        share_round2(F.col("ca"), total).alias("pct_total"),
    ).orderBy(F.col("ca_net").desc_nulls_first(), "codecli").limit(limit)
