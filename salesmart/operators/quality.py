"""Data-quality checks Q1–Q8 as Spark jobs.

Each check returns a small DataFrame (one row per rule / key / order
found) built from aggregates, anti-joins and scalar subqueries: nothing
is collected to the driver to be compared there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions import to_money
from salesmart.plans.model import Mart, Oltp


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


# --------------------------------------------------------------------- Q1
def dq_revenue_reconciliation(oltp: Oltp, mart: Mart) -> DataFrame:
    """Net revenue in the source lines vs in the mart. Not expected to be
    0: the mart rounds each line to cents."""
    d = oltp.detailcommande
    src = d.agg(F.sum(F.col("qte") * F.col("prixunit") * (F.lit(1) - F.col("remise"))).alias("ca_oltp"))
    dw = mart.fait_ventes.select(F.sum("montant_net")).scalar()
    return src.select(to_money(F.col("ca_oltp")).alias("ca_oltp"), to_money(dw).alias("ca_dw"),
                      to_money(dw - F.col("ca_oltp")).alias("ecart"))


# --------------------------------------------------------------------- Q2
def dq_order_count(oltp: Oltp, mart: Mart) -> DataFrame:
    """Orders in the source vs order-grain fact rows."""
    src = oltp.commande.agg(F.count(F.lit(1)).alias("commandes_oltp"))
    dw = mart.fait_livraisons.select(F.count(F.lit(1))).scalar()
    return src.select("commandes_oltp", dw.alias("commandes_dw"),
                      (F.col("commandes_oltp") - dw).alias("ecart"))


# --------------------------------------------------------------------- Q3
def key_specs(oltp: Oltp, mart: Mart) -> list[tuple[str, str, DataFrame, list[str]]]:
    """(table, key name, table, key columns) of every primary / unique key."""
    o, m = oltp, mart
    return [
        ("_categorie", "codecateg", o.categorie, ["codecateg"]),
        ("_fournisseur", "nofour", o.fournisseur, ["nofour"]),
        ("_client", "codecli", o.client, ["codecli"]),
        ("_employe", "noemp", o.employe, ["noemp"]),
        ("_transporteur", "notran", o.transporteur, ["notran"]),
        ("_produit", "refprod", o.produit, ["refprod"]),
        ("_commande", "nocom", o.commande, ["nocom"]),
        ("_detailcommande", "nocom,refprod", o.detailcommande, ["nocom", "refprod"]),
        ("dimTemps", "date_key", m.dim_temps, ["date_key"]),
        ("dimTemps", "date_jour", m.dim_temps, ["date_jour"]),
        ("dimClient", "client_key", m.dim_client, ["client_key"]),
        ("dimClient", "codecli", m.dim_client, ["codecli"]),
        ("dimEmploye", "employe_key", m.dim_employe, ["employe_key"]),
        ("dimEmploye", "noemp", m.dim_employe, ["noemp"]),
        ("dimTransporteur", "transporteur_key", m.dim_transporteur, ["transporteur_key"]),
        ("dimTransporteur", "notran", m.dim_transporteur, ["notran"]),
        ("dimGeoLivraison", "geo_key", m.dim_geo, ["geo_key"]),
        ("dimGeoLivraison", "paysliv,regionliv,villeliv,codepostalliv", m.dim_geo,
         ["paysliv", "regionliv", "villeliv", "codepostalliv"]),
        ("dimProduit", "produit_key", m.dim_produit, ["produit_key"]),
        ("dimProduit", "refprod", m.dim_produit, ["refprod"]),
        ("faitVentes", "ventes_key", m.fait_ventes, ["ventes_key"]),
        ("faitLivraisons", "liv_key", m.fait_livraisons, ["liv_key"]),
        ("faitLivraisons", "nocom", m.fait_livraisons, ["nocom"]),
    ]


def _key_code(df: DataFrame, cols: list[str]) -> tuple[F.Column, bool]:
    """A key as one number, and whether that number is the key itself. A single NULL has none; composite keys compare NULL fields as equal."""
    if len(cols) == 1:
        c = F.col(cols[0])
        if isinstance(df.schema[cols[0]].dataType, (T.LongType, T.IntegerType)):
            return c.cast("bigint"), True
        return F.when(c.isNotNull(), F.xxhash64(c)), False
    return F.xxhash64(*cols, *[F.col(c).isNull() for c in cols]), False


def dq_unique_keys(oltp: Oltp, mart: Mart) -> DataFrame:
    """Rows vs distinct keys per key; duplicates > 0 is a violation (for a
    hashed surrogate key it would be an unresolved collision). Composite
    keys compare NULL fields as equal.

    All keys of a table are counted in one pass with partial sums, as 64-bit
    numbers: integer keys as they are, others hashed. This runs at once and
    brings a row per key to the driver. Only keys of which some hash
    is seen more than once are counted again, by the key itself and for the
    rows of such hashes, so a clash of hashes is no duplicate.
    """
    tables: dict[str, tuple[DataFrame, list[tuple[str, list[str]]]]] = {}
    for table, key_name, df, cols in key_specs(oltp, mart):
        tables.setdefault(table, (df, []))[1].append((key_name, cols))
    repeated, found = {}, []
    for table, (df, keys) in tables.items():
        codes = [_key_code(df, cols) for _, cols in keys]
        integer = all(isinstance(df.schema[c].dataType, (T.LongType, T.IntegerType)) for _, cols in keys for c in cols)
        if len(keys) == 1 and integer:  # the columns themselves are as short as a hash of them
            exact, coded = [0], F.lit(0)
            known = reduce(lambda x, y: x | y, [F.col(c).isNotNull() for c in keys[0][1]]) | F.lit(len(keys[0][1]) > 1)
            counts = df.groupBy(*keys[0][1]).agg(F.count(F.lit(1)).alias("_n")).select(F.lit(0).alias("_k"), F.when(known, coded).alias("_code"), "_n")
        else:
            exact = [i for i, (_, same) in enumerate(codes) if same]
            pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("_k"), code.alias("_code")) for i, (code, _) in enumerate(codes)]))
            counts = df.select(pairs.alias("_p")).select("_p.*").groupBy("_k", "_code").agg(F.count(F.lit(1)).alias("_n"))
        sure = (F.col("_n") == 1) | F.col("_k").isin(exact)
        known = F.col("_code").isNotNull()
        repeated.update({(table, i): (df, cols, codes[i][0], counts.where((F.col("_k") == i) & (F.col("_n") > 1) & known).select("_code")) for i, (_, cols) in enumerate(keys)})
        found.append(counts.groupBy("_k").agg(F.sum("_n").alias("n_rows"), F.count(F.when(known & sure, 1)).alias("n_sure"), F.count(F.when(known & ~sure, 1)).alias("n_again"))
                     .withColumn("table_name", F.lit(table)))
    first = {(r["table_name"], r["_k"]): r for r in _union(found).collect()}  # a row per key
    parts, rows = [], []
    for table, (_, keys) in tables.items():
        for i, (key_name, _) in enumerate(keys):
            r = first.get((table, i))  # a table without rows has none
            n_rows, n_sure = (r["n_rows"], r["n_sure"]) if r else (0, 0)
            if not r or r["n_again"] == 0:
                rows.append((table, key_name, n_rows, n_sure, n_rows - n_sure))
                continue
            df, cols, code, again = repeated[table, i]
            more = df.select(*cols, code.alias("_code")).join(again, "_code", "left_semi").select(*cols).distinct().agg((F.count(F.lit(1)) + n_sure).alias("n_keys"))
            parts.append(more.select(F.lit(table).alias("table_name"), F.lit(key_name).alias("key_name"), F.lit(n_rows).cast("bigint").alias("n_rows"), "n_keys", (F.lit(n_rows) - F.col("n_keys")).alias("n_duplicates")))
    done = mart.fait_ventes.sparkSession.createDataFrame(rows, "table_name string, key_name string, n_rows bigint, n_keys bigint, n_duplicates bigint")
    return _union([done, *parts])


# --------------------------------------------------------------------- Q4
def fk_specs(oltp: Oltp, mart: Mart) -> list[tuple[str, DataFrame, str, DataFrame, str]]:
    o, m = oltp, mart
    return [
        ("_employe.rendcomptea", o.employe, "rendcomptea", o.employe, "noemp"),
        ("_produit.nofour", o.produit, "nofour", o.fournisseur, "nofour"),
        ("_produit.codecateg", o.produit, "codecateg", o.categorie, "codecateg"),
        ("_commande.codecli", o.commande, "codecli", o.client, "codecli"),
        ("_commande.noemp", o.commande, "noemp", o.employe, "noemp"),
        ("_commande.notran", o.commande, "notran", o.transporteur, "notran"),
        ("_detailcommande.nocom", o.detailcommande, "nocom", o.commande, "nocom"),
        ("_detailcommande.refprod", o.detailcommande, "refprod", o.produit, "refprod"),
        ("faitVentes.date_key", m.fait_ventes, "date_key", m.dim_temps, "date_key"),
        ("faitVentes.client_key", m.fait_ventes, "client_key", m.dim_client, "client_key"),
        ("faitVentes.employe_key", m.fait_ventes, "employe_key", m.dim_employe, "employe_key"),
        ("faitVentes.transporteur_key", m.fait_ventes, "transporteur_key", m.dim_transporteur, "transporteur_key"),
        ("faitVentes.produit_key", m.fait_ventes, "produit_key", m.dim_produit, "produit_key"),
        ("faitVentes.geo_key", m.fait_ventes, "geo_key", m.dim_geo, "geo_key"),
        ("faitLivraisons.datecom_key", m.fait_livraisons, "datecom_key", m.dim_temps, "date_key"),
        ("faitLivraisons.dateenv_key", m.fait_livraisons, "dateenv_key", m.dim_temps, "date_key"),
        ("faitLivraisons.dateobj_key", m.fait_livraisons, "dateobj_key", m.dim_temps, "date_key"),
        ("faitLivraisons.client_key", m.fait_livraisons, "client_key", m.dim_client, "client_key"),
        ("faitLivraisons.employe_key", m.fait_livraisons, "employe_key", m.dim_employe, "employe_key"),
        ("faitLivraisons.transporteur_key", m.fait_livraisons, "transporteur_key", m.dim_transporteur,
         "transporteur_key"),
        ("faitLivraisons.geo_key", m.fait_livraisons, "geo_key", m.dim_geo, "geo_key"),
    ]


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent (LEFT ANTI)."""
    c = child.filter(F.col(fk).isNotNull())
    return c.join(parent.select(F.col(pk).alias("_pk")), F.col(fk) == F.col("_pk"), "left_anti")


def _kind(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> str:
    """The type in which a reference and its key are compared."""
    one, other = child.schema[fk].dataType, parent.schema[pk].dataType
    if isinstance(one, T.IntegralType) and isinstance(other, T.IntegralType):
        return "bigint"
    return one.simpleString() if one == other else "string"


def dq_foreign_keys(oltp: Oltp, mart: Mart) -> DataFrame:
    """Orphan count per reference (nullable references skip NULL).

    The references of a child table are taken by type, in which they stay:
    unpivoted to (number of the reference, key), reduced to a row per key with
    partial sums, and anti-joined with the keys of all parents of the type at
    once. Each column is read once, by the scan for its type.
    """
    children: dict[tuple[int, str], tuple[DataFrame, list[tuple[str, str, DataFrame, str]]]] = {}
    for name, child, fk, parent, pk in fk_specs(oltp, mart):
        children.setdefault((id(child), _kind(child, fk, parent, pk)), (child, []))[1].append((name, fk, parent, pk))
    parts = []
    for (_, kind), (child, refs) in children.items():
        if len(refs) == 1:
            pairs = child.select(F.lit(0).alias("_ref"), F.col(refs[0][1]).cast(kind).alias("_k"))
        else:
            pairs = child.select(F.inline(F.array(*[F.struct(F.lit(i).alias("_ref"), F.col(fk).cast(kind).alias("_k")) for i, (_, fk, _, _) in enumerate(refs)])))
        keys = pairs.where(F.col("_k").isNotNull()).groupBy("_ref", "_k").agg(F.count(F.lit(1)).alias("_n"))
        parents = _union([parent.select(F.lit(i).alias("_ref"), F.col(pk).cast(kind).alias("_k")) for i, (_, _, parent, pk) in enumerate(refs)])
        missing = keys.join(parents, ["_ref", "_k"], "left_anti").select("_ref", "_n")
        none = child.sparkSession.range(len(refs)).select(F.col("id").cast("int").alias("_ref"), F.lit(0).cast("bigint").alias("_n"))
        named = F.element_at(F.array(*[F.lit(name) for name, _, _, _ in refs]), F.col("_ref") + 1)
        parts.append(missing.unionByName(none).groupBy("_ref").agg(F.sum("_n").alias("n_orphans")).select(named.alias("fk_name"), "n_orphans"))
    return _union(parts)


# --------------------------------------------------------------------- Q5
def line_rule_flags() -> dict[str, F.Column]:
    q, r = F.col("qte"), F.col("remise")
    return {
        "n_qte_invalide": q.isNull() | (q <= 0),
        "n_remise_hors_bornes": (r < 0) | (r > 1),
        "n_remise_nulle": r.isNull(),
    }


def dq_line_checks(oltp: Oltp) -> DataFrame:
    """Counts of lines breaking qte > 0, 0 ≤ remise ≤ 1, or with no remise
    (one pass over the lines)."""
    flags = line_rule_flags()
    return oltp.detailcommande.agg(
        F.count(F.lit(1)).alias("n_lignes"),
        *[F.count(F.when(cond, 1)).alias(name) for name, cond in flags.items()])


def quarantined_lines(oltp: Oltp) -> DataFrame:
    """The offending lines themselves, with the rule they break."""
    flags = line_rule_flags()
    d = oltp.detailcommande
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]))
    return d.withColumn("regles", broken).filter(F.size("regles") > 0)


# --------------------------------------------------------------------- Q6
NOT_NULL = {
    "dim_temps": ["date_key", "date_jour", "annee", "trimestre", "mois", "semaine_iso", "jour_mois",
                  "jour_semaine_iso"],
    "dim_client": ["codecli"],
    "dim_employe": ["noemp"],
    "dim_transporteur": ["notran"],
    "dim_produit": ["refprod"],
    "fait_ventes": ["date_key", "client_key", "employe_key", "produit_key", "nocom", "qte", "prixunit",
                    "remise", "montant_brut", "montant_net", "port_alloc"],
    "fait_livraisons": ["datecom_key", "client_key", "employe_key", "nocom"],
}


def dq_not_null(mart: Mart) -> DataFrame:
    """NULL count per NOT NULL column of the mart (one pass per table)."""
    parts = []
    for table, cols in NOT_NULL.items():
        df = getattr(mart, table)
        wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
        long = wide.unpivot([], cols, "column_name", "n_nulls")
        parts.append(long.select(F.lit(table).alias("table_name"), "column_name", "n_nulls"))
    return _union(parts)


# --------------------------------------------------------------------- Q7
def dq_orders_without_lines(oltp: Oltp) -> DataFrame:
    """Order headers with no line (they exist only in the delivery fact)."""
    return (oltp.commande.select("nocom", "codecli", "datecom")
            .join(oltp.detailcommande.select("nocom").distinct(), "nocom", "left_anti"))


# --------------------------------------------------------------------- Q8
def dq_freight_residual(mart: Mart) -> DataFrame:
    """Orders whose allocated freight does not add up to their freight
    (cent rounding per line); one pre-aggregated row per order joined to
    the order-grain fact."""
    alloc = mart.fait_ventes.groupBy("nocom").agg(F.sum("port_alloc").alias("alloue"))
    j = alloc.join(mart.fait_livraisons.select("nocom", "port"), "nocom")
    diff = F.col("alloue") - F.col("port")
    return j.filter(diff != 0).select(
        "nocom", to_money(F.col("port")).alias("port"), to_money(F.col("alloue")).alias("port_alloue"),
        to_money(diff).alias("ecart"))
