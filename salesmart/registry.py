"""Every registered query: name → callable(spark, sf_dir) → DataFrame.

Each query reads the given tables of ``sf_dir`` through the test-data
adapter, builds the mart lazily and runs one operator over the whole
tables. Results carry natural keys only (surrogate keys are internal),
so an independent SQL engine can check them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions import to_money
from salesmart.operators import dims, facts, finance, logistics, quality, report_layer
from salesmart.operators.merge import insert_if_absent
from salesmart.plans.mart import build_mart, table_counts
from salesmart.plans.model import Mart, Oltp
from salesmart.plans.period import Period
from salesmart.sources.testdata import load_oltp

_CACHE: dict[tuple[str, str], tuple[Oltp, Mart]] = {}

# Fixed parameters of the registered period / slicer examples.
EXAMPLE_PERIOD = Period(annee=1998, mois=8)
EXAMPLE_SLICER = {"paysliv": ["NATION_1", "NATION_2", "NATION_3"], "semaine_iso": list(range(1, 14))}
EXAMPLE_COUNTRY, EXAMPLE_CATEGORY = "NATION_8", "PROMO"
INCREMENTAL_CUTOFF = "1998-01-01"


def context(spark: SparkSession, sf_dir: str) -> tuple[Oltp, Mart]:
    """Lazy source tables and mart of ``sf_dir`` (memoised per session)."""
    try:
        app = spark.sparkContext.applicationId
    except PySparkException:  # a remote (Connect) session has no SparkContext
        app = str(id(spark))
    key = (app, sf_dir)
    if key not in _CACHE:
        oltp = load_oltp(spark, sf_dir)
        _CACHE[key] = (oltp, build_mart(oltp))
    return _CACHE[key]


# ------------------------------------------------------------ load views
def q_date_bounds(o: Oltp) -> DataFrame:
    return dims.date_bounds(o.commande)


def q_dim_customer(m: Mart) -> DataFrame:
    return m.dim_client.drop("client_key")


def q_dim_employee(m: Mart) -> DataFrame:
    return m.dim_employe.drop("employe_key")


def q_dim_carrier(m: Mart) -> DataFrame:
    return m.dim_transporteur.drop("transporteur_key")


def q_dim_geo(m: Mart) -> DataFrame:
    return m.dim_geo.drop("geo_key")


def q_dim_product(m: Mart) -> DataFrame:
    return m.dim_produit.drop("produit_key").withColumn("prixcatalogue", to_money(F.col("prixcatalogue")))


def q_null_if_sentinel(m: Mart) -> DataFrame:
    """NULL count per cleaned column of the customer and address dims."""
    parts = []
    for table, df, cols in (("dimClient", m.dim_client, ["societe", "contact", "fonction", "ville", "region",
                                                         "pays", "codepostal"]),
                            ("dimGeoLivraison", m.dim_geo, list(dims.GEO_COLS))):
        wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
        parts.append(wide.unpivot([], cols, "column_name", "n_nulls")
                     .select(F.lit(table).alias("table_name"), "column_name", "n_nulls"))
    return parts[0].unionByName(parts[1])


def q_surrogate_key(m: Mart) -> DataFrame:
    """Per dimension: rows, distinct surrogate keys, distinct natural keys."""
    specs = [("dimClient", m.dim_client, "client_key", ["codecli"]),
             ("dimEmploye", m.dim_employe, "employe_key", ["noemp"]),
             ("dimTransporteur", m.dim_transporteur, "transporteur_key", ["notran"]),
             ("dimGeoLivraison", m.dim_geo, "geo_key", list(dims.GEO_COLS)),
             ("dimProduit", m.dim_produit, "produit_key", ["refprod"])]
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(sk).alias("n_surrogate"),
                    F.countDistinct(F.struct(*nk)).alias("n_natural"))
             .select(F.lit(t).alias("table_name"), "n_rows", "n_surrogate", "n_natural")
             for t, df, sk, nk in specs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_insert_if_absent(o: Oltp) -> DataFrame:
    """Address dim loaded in two batches: orders before the cutoff, then
    all orders; members of the first batch keep their row."""
    first = dims.dim_geo(o.commande.filter(F.col("datecom") < F.lit(INCREMENTAL_CUTOFF).cast("date")))
    both = insert_if_absent(first, dims.dim_geo(o.commande), list(dims.GEO_COLS))
    return both.drop("geo_key")


def q_date_key(m: Mart) -> DataFrame:
    return m.fait_livraisons.select("nocom", "datecom_key", "dateenv_key", "dateobj_key")


def q_fact_deliveries(m: Mart) -> DataFrame:
    fl = m.fait_livraisons
    return (fl.join(m.dim_client.select("client_key", "codecli"), "client_key")
            .join(m.dim_geo, "geo_key", "left")
            .select("nocom", "datecom_key", "dateenv_key", "dateobj_key", "codecli",
                    F.col("employe_key").cast("int").alias("noemp"),
                    F.col("transporteur_key").cast("int").alias("notran"),
                    *dims.GEO_COLS, to_money(F.col("port")).alias("port"), "delai_envoi_jours", "retard_jours"))


def q_fact_sales(m: Mart) -> DataFrame:
    fv = m.fait_ventes
    return (fv.join(m.dim_client.select("client_key", "codecli"), "client_key")
            .join(m.dim_geo, "geo_key", "left")
            .select("nocom", F.col("produit_key").alias("refprod"), "date_key", "codecli",
                    F.col("employe_key").cast("int").alias("noemp"),
                    F.col("transporteur_key").cast("int").alias("notran"),
                    *dims.GEO_COLS, "qte",
                    to_money(F.col("prixunit")).alias("prixunit"),
                    F.col("remise").cast("double").alias("remise"),
                    to_money(F.col("montant_brut")).alias("montant_brut"),
                    to_money(F.col("montant_net")).alias("montant_net"),
                    to_money(F.col("port_alloc")).alias("port_alloc")))


def q_line_amounts(o: Oltp) -> DataFrame:
    la = facts.line_amounts(o.detailcommande)
    return la.select("nocom", "refprod", "qte", to_money(F.col("prixunit")).alias("prixunit"),
                     F.col("remise").cast("double").alias("remise"),
                     to_money(F.col("montant_brut")).alias("montant_brut"),
                     to_money(F.col("montant_net")).alias("montant_net"))


def q_order_net_total(o: Oltp) -> DataFrame:
    t = facts.order_net_total(facts.line_amounts(o.detailcommande))
    return t.select("nocom", to_money(F.col("total_net")).alias("total_net"))


def q_allocate_freight(m: Mart) -> DataFrame:
    return m.fait_ventes.select("nocom", F.col("produit_key").alias("refprod"),
                                to_money(F.col("montant_net")).alias("montant_net"),
                                to_money(F.col("port_alloc")).alias("port_alloc"))


def q_null_safe_geo_lookup(m: Mart) -> DataFrame:
    return m.fait_livraisons.select("nocom", "geo_key").join(m.dim_geo, "geo_key", "left").drop("geo_key")


def _in_country(m: Mart) -> Mart:
    return report_layer.slice_mart(m, {"paysliv": [EXAMPLE_COUNTRY]})


def q_insert_if_absent_client(o: Oltp) -> DataFrame:
    """E10 on customers that the batch repeats with another contact: existing
    members (odd codes) keep their row, the others collapse to their first."""
    rows = dims.client_rows(o.client)
    again = rows.withColumn("contact", F.concat(F.lit("CONTACT_"), "codecli"))
    existing = rows.filter(F.col("codecli").cast("bigint") % 2 == 1)
    return insert_if_absent(existing, rows.unionByName(again), ["codecli"], order_by=["contact"])


def q_refresh(m: Mart) -> DataFrame:
    """Rows of each table, and the sum of its amount where it has one."""
    amounts = {"fait_ventes": "montant_net", "fait_livraisons": "port", "dim_produit": "prixcatalogue"}
    sums = [df.select(F.lit(name).alias("table_name"), to_money(F.sum(amounts[name])).alias("total"))
            for name, df in m.tables().items() if name in amounts]
    total = sums[0].unionByName(sums[1]).unionByName(sums[2])
    return table_counts(m).join(total, "table_name", "left").select("table_name", "n_rows", F.coalesce("total", F.lit(0.0)).alias("total"))


def q_dim_date(m: Mart) -> DataFrame:
    return m.dim_temps


OPERATORS: dict[str, tuple[str, Callable]] = {
    # finance business queries
    "f1_discounts": ("mart", finance.f1_discounts),
    "f2_revenue_product": ("mart", finance.f2_revenue_product),
    "f3_revenue_country": ("mart", finance.f3_revenue_country),
    "f4_revenue_carrier": ("mart", finance.f4_revenue_carrier),
    "f5_orders_employee_customer": ("mart", finance.f5_orders_employee_customer),
    "f6_revenue_supplier_product": ("mart", finance.f6_revenue_supplier_product),
    "f7_freight_carrier": ("mart", finance.f7_freight_carrier),
    "f8_top_customers_period": ("mart", finance.f8_top_customers_period),
    # logistics business queries
    "l1_date_gaps": ("mart", logistics.l1_date_gaps),
    "l2_reorder": ("mart", logistics.l2_reorder),
    "l3_qty_zone": ("mart", logistics.l3_qty_zone),
    "l4_same_country_supplier": ("mart", logistics.l4_same_country_supplier),
    "l5_shipping_delay": ("mart", logistics.l5_shipping_delay),
    # views, first file
    "v_revenue_period": ("mart", finance.v_revenue_period),
    "v_revenue_product_full": ("mart", finance.v_revenue_product_full),
    "v_revenue_delivery_country": ("mart", finance.v_revenue_delivery_country),
    "v_revenue_carrier": ("mart", finance.v_revenue_carrier),
    "v_discounts_agg": ("mart", finance.v_discounts_agg),
    "v_delays": ("mart", logistics.v_delays),
    "v_qty_zone_all": ("mart", logistics.v_qty_zone_all),
    "v_carrier_stats": ("mart", logistics.v_carrier_stats),
    # views, second file
    "vf1_discounts": ("mart", finance.vf1_discounts),
    "vf2_revenue_product": ("mart", finance.vf2_revenue_product),
    "vf2_revenue_category": ("mart", finance.vf2_revenue_category),
    "vf3_revenue_country": ("mart", finance.vf3_revenue_country),
    "vf4_revenue_carrier": ("mart", finance.vf4_revenue_carrier),
    "vf5_orders_employee": ("mart", finance.vf5_orders_employee),
    "vf5_avg_discount_customer": ("mart", finance.vf5_avg_discount_customer),
    "vf6_supplier_product": ("mart", finance.vf6_supplier_product),
    "vf7_freight_carrier": ("mart", finance.vf7_freight_carrier),
    "vf8_top_customers": ("mart", finance.vf8_top_customers),
    "vl1_largest_delays": ("mart", logistics.vl1_largest_delays),
    "vl2_reorder": ("oltp", logistics.vl2_reorder),
    "vl3_qty_zone": ("mart", logistics.vl3_qty_zone),
    "vl4_same_region_supplier": ("oltp", logistics.vl4_same_region_supplier),
    "vl5_late_rate_carrier": ("mart", logistics.vl5_late_rate_carrier),
    # load (ETL) operators
    "date_bounds": ("oltp", q_date_bounds),
    "dim_date": ("mart", q_dim_date),
    "null_if_sentinel": ("mart", q_null_if_sentinel),
    "dim_customer": ("mart", q_dim_customer),
    "dim_employee": ("mart", q_dim_employee),
    "dim_carrier": ("mart", q_dim_carrier),
    "dim_delivery_geo": ("mart", q_dim_geo),
    "dim_product": ("mart", q_dim_product),
    "surrogate_key": ("mart", q_surrogate_key),
    "insert_if_absent": ("oltp", q_insert_if_absent),
    "date_key": ("mart", q_date_key),
    "fact_deliveries": ("mart", q_fact_deliveries),
    "line_amounts": ("oltp", q_line_amounts),
    "order_net_total": ("oltp", q_order_net_total),
    "allocate_freight": ("mart", q_allocate_freight),
    "fact_sales": ("mart", q_fact_sales),
    "null_safe_geo_lookup": ("mart", q_null_safe_geo_lookup),
    "refresh": ("mart", q_refresh),
    # period and report layer
    "period_filter": ("mart", lambda m: finance.f2_revenue_product(m, EXAMPLE_PERIOD)),
    "period_grain": ("mart", lambda m: finance.f5_orders_employee_customer(m, grain="trimestre")),
    "slicer": ("mart", lambda m: report_layer.slicer(logistics.l3_qty_zone(m), EXAMPLE_SLICER)),
    "slicer_l1_country": ("mart", lambda m: logistics.l1_date_gaps(_in_country(m))),
    "slicer_f8_country": ("mart", lambda m: finance.f8_top_customers_period(_in_country(m))),
    "slicer_kpi_category": ("mart", lambda m: report_layer.kpi_finance(report_layer.slice_mart(m, {"nomcateg": [EXAMPLE_CATEGORY]}))),
    "period_week": ("mart", lambda m: finance.f2_revenue_product(m, Period(semaine_iso=1))),
    "period_grain_year": ("mart", lambda m: finance.f5_orders_employee_customer(m, grain="annee")),
    "period_grain_l5_month": ("mart", lambda m: logistics.l5_shipping_delay(m, grain="mois")),
    "role_date_report_target": ("mart", lambda m: report_layer.role_date_report(m, "obj")),
    "insert_if_absent_client": ("oltp", q_insert_if_absent_client),
    "kpi_finance": ("mart", report_layer.kpi_finance),
    "kpi_shipments": ("mart", report_layer.kpi_shipments),
    "price_vs_quantity": ("mart", report_layer.price_vs_quantity),
    "discount_distribution": ("mart", report_layer.discount_distribution),
    "top_n": ("mart", report_layer.top_customers_per_year),
    "supplier_product_matrix": ("mart", report_layer.supplier_product_matrix),
    "role_date_report": ("mart", report_layer.role_date_report),
    "gap_direction": ("mart", report_layer.gap_direction),
    # data quality
    "dq_revenue_reconciliation": ("both", quality.dq_revenue_reconciliation),
    "dq_order_count": ("both", quality.dq_order_count),
    "dq_unique_keys": ("both", quality.dq_unique_keys),
    "dq_foreign_keys": ("both", quality.dq_foreign_keys),
    "dq_line_checks": ("oltp", quality.dq_line_checks),
    "dq_not_null": ("mart", quality.dq_not_null),
    "dq_orders_without_lines": ("oltp", quality.dq_orders_without_lines),
    "dq_freight_residual": ("mart", quality.dq_freight_residual),
}


def apply(name: str, oltp: Oltp, mart: Mart) -> DataFrame:
    """Run operator ``name`` on given source tables and mart."""
    kind, fn = OPERATORS[name]
    if kind == "mart":
        return fn(mart)
    if kind == "oltp":
        return fn(oltp)
    return fn(oltp, mart)


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return apply(name, *context(spark, sf_dir))
    run.__name__ = name
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _query(name) for name in OPERATORS}
