"""Adapter: the driver's TPC-H-like parquet tables → the 8 source tables.

The test tables have no employee, carrier, freight, ship/target date or
stock data; those are derived by integer rules that DuckDB reproduces
exactly (see FIXTURES.md §2 and ``salesmart.oracle``). Parquet has no
NULLs, so NULLs and the sentinel are injected by rule too.

Everything is a lazy DataFrame over the given tables. Nothing is lost on
the way: a customer or supplier without nation, and an order without
customer, stay and reach the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.plans.model import Oltp
from salesmart.schema import OLTP_SCHEMAS, SENTINEL

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed rule parameters of the fixture mapping.
NO_CARRIER_PRIORITY = "4-NOT SPECIFIED"
N_EMPLOYEES = 10
TARGET_DAYS = 28


def _conform(df: DataFrame, name: str) -> DataFrame:
    """Select the declared columns in order, adding absent ones as NULL."""
    schema = OLTP_SCHEMAS[name]
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def read_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}


def load_oltp(spark: SparkSession, sf_dir: str) -> Oltp:
    t = read_tables(spark, sf_dir)
    nation_region = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name")

    cust = t["customer"].join(nation_region, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey",
        F.col("c_custkey").cast("string").alias("codecli"),
        F.col("c_name").alias("societe"),
        F.col("c_mktsegment").alias("fonction"),
        F.concat(F.lit("VILLE_"), (F.col("c_custkey") % 4).cast("string")).alias("ville"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit(SENTINEL)).otherwise(F.col("r_name")).alias("region"),
        F.when(F.col("c_custkey") % 11 != 0, (F.col("c_nationkey") + 10000).cast("string")).alias("codepostal"),
        F.col("n_name").alias("pays"),
    )
    client = _conform(cust, "client")

    fournisseur = _conform(
        t["supplier"].join(nation_region, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
            F.col("s_suppkey").alias("nofour"),
            F.col("s_name").alias("societe"),
            F.when(F.col("s_suppkey") % 5 == 0, F.lit(SENTINEL)).otherwise(F.col("r_name")).alias("region"),
            F.col("n_name").alias("pays"),
        ),
        "fournisseur",
    )

    # One category per part type; its code is the smallest part key of the
    # type (distributed: a partial aggregate, no global ranking).
    categorie = _conform(
        t["part"].groupBy(F.col("p_type").alias("nomcateg")).agg(F.min("p_partkey").alias("codecateg")),
        "categorie",
    )

    # Supplier keys are 0..n-1: each part gets supplier partkey mod n, n being
    # a scalar subquery over the supplier table (evaluated once, no join).
    n_suppliers = t["supplier"].select(F.count(F.lit(1))).scalar()
    produit = _conform(
        t["part"].join(categorie.select("codecateg", F.col("nomcateg").alias("p_type")), "p_type").select(
            F.col("p_partkey").alias("refprod"),
            F.col("p_name").alias("nomprod"),
            (F.col("p_partkey") % n_suppliers).alias("nofour"),
            "codecateg",
            F.col("p_retailprice").cast("decimal(10,2)").alias("prixunit"),
            F.col("p_size").alias("unitesstock"),
            (F.col("p_partkey") % 20).alias("unitescom"),
            F.when(F.col("p_partkey") % 13 != 0, F.col("p_partkey") % 30).alias("niveaureap"),
            F.when(F.col("p_partkey") % 10 == 0, 1).otherwise(0).alias("indisponible"),
        ),
        "produit",
    )

    orders = t["orders"]
    # The employees are those the orders name; the first is the others' manager.
    noemp = F.col("o_orderkey") % N_EMPLOYEES + 1
    employe = _conform(
        orders.select(noemp.alias("noemp")).distinct().select(
            "noemp",
            F.concat(F.lit("NOM_"), F.col("noemp").cast("string")).alias("nom"),
            F.concat(F.lit("PRENOM_"), F.col("noemp").cast("string")).alias("prenom"),
            F.when(F.col("noemp") != 1, F.lit(1)).alias("rendcomptea"),
        ),
        "employe",
    )

    carrier_no = F.substring("o_orderpriority", 1, 1).cast("int")
    transporteur = _conform(
        orders.filter(F.col("o_orderpriority") != NO_CARRIER_PRIORITY)
        .select(carrier_no.alias("notran"), F.col("o_orderpriority").alias("nomtran"))
        .distinct(),
        "transporteur",
    )

    datecom = F.col("o_orderdate").cast("date")
    okey = F.col("o_orderkey")
    commande = _conform(
        orders.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left").select(
            okey.alias("nocom"),
            F.col("o_custkey").cast("string").alias("codecli"),
            (okey % N_EMPLOYEES + 1).alias("noemp"),
            datecom.alias("datecom"),
            F.when(okey % 23 != 0, F.date_add(datecom, TARGET_DAYS)).alias("dateobjliv"),
            F.when(okey % 17 != 0, F.date_add(datecom, (okey % 45).cast("int"))).alias("dateenv"),
            F.when(F.col("o_orderpriority") != NO_CARRIER_PRIORITY, carrier_no).alias("notran"),
            F.expr("CAST(((o_orderkey * 37) % 20000) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))").alias("port"),
            F.col("ville").alias("villeliv"),
            F.col("region").alias("regionliv"),
            F.col("codepostal").alias("codepostalliv"),
            F.col("pays").alias("paysliv"),
        ),
        "commande",
    )

    detail = _conform(
        t["lineitem"].select(
            F.col("l_orderkey").alias("nocom"),
            F.col("l_partkey").alias("refprod"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("prixunit"),
            F.col("l_quantity").cast("int").alias("qte"),
            F.col("l_discount").cast("decimal(3,2)").alias("remise"),
        ),
        "detailcommande",
    )

    return Oltp(
        categorie=categorie, fournisseur=fournisseur, client=client, employe=employe,
        transporteur=transporteur, produit=produit, commande=commande, detailcommande=detail,
    )
