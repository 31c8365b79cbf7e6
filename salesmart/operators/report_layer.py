"""Report layer R1–R9: slicers, KPI rows, scatter / distribution data,
generic top-N, the supplier matrix, date roles and gap direction."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions import avg_exact, to_money
from salesmart.operators.finance import _label, deliveries, f6_revenue_supplier_product, sales
from salesmart.plans.model import Mart
from salesmart.plans.period import ROLE_KEYS, Period, finance_grain
from salesmart.schema import GAP_EARLY, GAP_LATE, GAP_ON_TIME, UNKNOWN_LABEL


# --------------------------------------------------------------------- R1
def slicer(df: DataFrame, selections: Mapping[str, Iterable], include_null: Iterable[str] = ()) -> DataFrame:
    """Multi-value filter per column; an empty selection means no filter.
    NULL members are kept only for the columns named in ``include_null``."""
    keep_null = set(include_null)
    for col, values in selections.items():
        values = list(values)
        if not values and col not in keep_null:
            continue
        cond = F.col(col).isin(values) if values else F.lit(False)
        if col in keep_null:
            cond = cond | F.col(col).isNull()
        df = df.filter(cond)
    return df


#: Dimension, its key in the facts, and the facts that have it, by column that can be selected on.
_MEMBERS = {
    **{c: ("dim_client", "client_key") for c in ("codecli", "societe", "ville", "region", "pays")},
    **{c: ("dim_employe", "employe_key") for c in ("noemp", "nom", "prenom", "rendcomptea")},
    **{c: ("dim_transporteur", "transporteur_key") for c in ("notran", "nomtran")},
    **{c: ("dim_geo", "geo_key") for c in ("paysliv", "regionliv", "villeliv", "codepostalliv")},
    **{c: ("dim_produit", "produit_key") for c in ("refprod", "nomprod", "codecateg", "nomcateg", "nofour",
                                                   "fournisseur_societe", "fournisseur_pays", "fournisseur_region")},
}


def slice_mart(mart: Mart, selections: Mapping[str, Iterable], include_null: Iterable[str] = ()) -> Mart:
    """R1 before aggregation: the mart with its facts cut to the selected members.

    Every report on the result filters first, then aggregates, ranks,
    limits and takes shares, like the visuals of a page under its slicers.
    A selection on a product column cuts the sales only (deliveries have no
    product). ``include_null`` keeps facts without a member, or whose member
    has no value, for the columns it names.
    """
    keep_null = set(include_null)
    chosen: dict[tuple[str, str], dict[str, Iterable]] = {}
    for col, values in selections.items():
        if col not in _MEMBERS:
            raise ValueError(f"no dimension column {col!r}; one of {sorted(_MEMBERS)}")
        values = list(values)
        if values or col in keep_null:
            chosen.setdefault(_MEMBERS[col], {})[col] = values
    ventes, livraisons = mart.fait_ventes, mart.fait_livraisons
    for (dim, key), wanted in chosen.items():
        members = slicer(getattr(mart, dim), wanted, keep_null).select(F.col(key).alias("_member"))
        cut = lambda fact: _cut(fact, key, members, set(wanted) <= keep_null)  # noqa: B023, E731 - used at once
        ventes = cut(ventes)
        if key in livraisons.columns:
            livraisons = cut(livraisons)
    return replace(mart, fait_ventes=ventes, fait_livraisons=livraisons)


def _cut(fact: DataFrame, key: str, members: DataFrame, keep_null: bool) -> DataFrame:
    known = fact.join(members, fact[key] == members["_member"], "left_semi")
    return known.unionByName(fact.where(F.col(key).isNull())) if keep_null else known


# --------------------------------------------------------------------- R2
def kpi_finance(mart: Mart, period: Period | None = None) -> DataFrame:
    """One KPI row: revenue, gross, discount and freight amounts, orders,
    quantity and lines of the scope.

    The sums are a plain global aggregate (one partial row per task); the
    distinct order count is a separate scalar subquery over the order key
    alone. Together in one aggregate, Spark would shuffle an order-grain
    row carrying every partial sum just to count distinct orders.
    """
    s = sales(mart, period, ["annee"]) if period is not None else mart.fait_ventes
    orders = s.select("nocom").distinct().select(F.count(F.lit(1))).scalar()
    return s.agg(
        to_money(F.sum("montant_net")).alias("ca_net"),
        to_money(F.sum("montant_brut")).alias("ca_brut"),
        to_money(F.sum(F.col("montant_brut") - F.col("montant_net"))).alias("remise_montant"),
        to_money(F.sum("port_alloc")).alias("port_total"),
        F.sum("qte").cast("bigint").alias("qte_totale"),
        F.count(F.lit(1)).alias("nb_lignes"),
    ).select("ca_net", "ca_brut", "remise_montant", "port_total", orders.alias("nb_commandes"),
             "qte_totale", "nb_lignes")


# --------------------------------------------------------------------- R3
def kpi_shipments(mart: Mart, period: Period | None = None,
                  selections: Mapping[str, Iterable] | None = None) -> DataFrame:
    """Number of shipments (orders) in the scope; slicers may name the
    delivery country (``paysliv``) and carrier (``nomtran``)."""
    fl = deliveries(mart, period, ["annee"]) if period is not None else mart.fait_livraisons
    if selections:
        fl = (fl.join(mart.dim_geo.select("geo_key", "paysliv"), "geo_key", "left")
              .join(mart.dim_transporteur.select("transporteur_key", "nomtran"), "transporteur_key", "left"))
        fl = slicer(fl, selections)
    return fl.agg(F.count(F.lit(1)).alias("nb_expeditions"))


# --------------------------------------------------------------------- R4
def price_vs_quantity(mart: Mart, period: Period | None = None) -> DataFrame:
    """Per product: average unit price (x), quantity (y), net revenue (size)."""
    s = sales(mart, period, ["annee"]) if period is not None else mart.fait_ventes
    base = s.groupBy("produit_key").agg(
        avg_exact(F.col("prixunit")).alias("prix_moyen"), F.sum("qte").alias("qte_totale"),
        F.sum("montant_net").alias("ca"))
    return (base.join(mart.dim_produit.select("produit_key", "refprod", "nomprod"), "produit_key")
            .select("refprod", "nomprod", "prix_moyen", "qte_totale", to_money(F.col("ca")).alias("ca_net")))


# --------------------------------------------------------------------- R5
def discount_distribution(mart: Mart, period: Period | None = None) -> DataFrame:
    """Lines, quantity and net revenue per discount rate."""
    s = sales(mart, period, ["annee"]) if period is not None else mart.fait_ventes
    g = s.groupBy("remise").agg(F.count(F.lit(1)).alias("nb_lignes"), F.sum("qte").alias("qte_totale"),
                                F.sum("montant_net").alias("ca"))
    return g.select(F.col("remise").cast("double").alias("remise"), "nb_lignes", "qte_totale",
                    to_money(F.col("ca")).alias("ca_net")).orderBy("remise")


# --------------------------------------------------------------------- R6
def top_n(df: DataFrame, n: int, order: Sequence[Column | str], per: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows by ``order`` (give a unique tie-break last), overall
    or per group of ``per``.

    Overall it is a per-task top-n merged on one task (n rows per task);
    per group, Spark inserts a partial per-group limit before the shuffle
    (window group limit), so a hot group never moves more than n rows per
    task.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    if not per:
        return df.orderBy(*order).limit(n)
    w = Window.partitionBy(*per).orderBy(*order)
    return df.withColumn("rang", F.row_number().over(w)).filter(F.col("rang") <= n)


def top_customers_per_year(mart: Mart, n: int = 5) -> DataFrame:
    """R6 applied: the ``n`` best customers by net revenue in each year."""
    base = (sales(mart, None, ["annee"]).groupBy("annee", "client_key").agg(F.sum("montant_net").alias("ca"))
            .join(mart.dim_client.select("client_key", "codecli", "societe"), "client_key")
            .select("annee", "codecli", "societe", to_money(F.col("ca")).alias("ca_net")))
    return top_n(base, n, [F.col("ca_net").desc(), F.col("codecli")], per=["annee"])


# --------------------------------------------------------------------- R7
def supplier_product_matrix(mart: Mart, period: Period | None = None, grain: str = "annee") -> DataFrame:
    """Supplier → product matrix with supplier subtotals (F6 by year)."""
    return f6_revenue_supplier_product(mart, period, grain)


# --------------------------------------------------------------------- R8
def role_date_report(mart: Mart, role: str = "env", period: Period | None = None,
                     grain: str = "mois") -> DataFrame:
    """Shipments and freight per period of the order, ship or target date.
    Orders without that date are outside every period (inner calendar join)."""
    if role not in ROLE_KEYS:
        raise ValueError(f"role must be one of {sorted(ROLE_KEYS)}, got {role!r}")
    P = finance_grain(grain)
    fl = deliveries(mart, period, P, role_key=ROLE_KEYS[role])
    g = fl.groupBy(*P).agg(F.count(F.lit(1)).alias("nb_expeditions"), F.sum("port").alias("p"))
    return g.select(*P, "nb_expeditions", to_money(F.col("p")).alias("port_total")).orderBy(*P)


# --------------------------------------------------------------------- R9
def gap_direction_label(gap: Column) -> Column:
    """Negative gap = shipped before the target (early), positive = late."""
    return (F.when(gap < 0, F.lit(GAP_EARLY)).when(gap > 0, F.lit(GAP_LATE))
            .when(gap == 0, F.lit(GAP_ON_TIME)).otherwise(F.lit(UNKNOWN_LABEL)))


def gap_direction(mart: Mart, period: Period | None = None) -> DataFrame:
    """Orders per direction of the signed ship-vs-target gap, per carrier."""
    fl = deliveries(mart, period, ["annee"]) if period is not None else mart.fait_livraisons
    cal = mart.dim_temps
    fl = (fl.join(cal.select(F.col("date_key").alias("dateenv_key"), F.col("date_jour").alias("_env")),
                  "dateenv_key", "left")
          .join(cal.select(F.col("date_key").alias("dateobj_key"), F.col("date_jour").alias("_obj")),
                "dateobj_key", "left"))
    gap = F.datediff("_env", "_obj")
    g = (fl.join(mart.dim_transporteur.select("transporteur_key", "nomtran"), "transporteur_key", "left")
         .groupBy("nomtran", gap_direction_label(gap).alias("sens")).agg(F.count(F.lit(1)).alias("nb_commandes")))
    return g.select(_label("nomtran").alias("transporteur"), "sens", "nb_commandes")
