"""Dimension loads E1–E8.

Dimensions keep the source's natural key next to a deterministic
surrogate key (see ``salesmart.functions.keys``). Members that the source
repeats collapse to one when a dimension is loaded (``operators.merge``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import clean, date_key, iso_weekday
from salesmart.functions.keys import natural_key
from salesmart.schema import SENTINEL

GEO_COLS = ("paysliv", "regionliv", "villeliv", "codepostalliv")


def date_bounds(commande: DataFrame) -> DataFrame:
    """First order date, and last of order / ship / target dates (1 row)."""
    last = F.greatest(
        F.col("datecom"),
        F.coalesce("dateenv", "datecom"),
        F.coalesce("dateobjliv", "datecom"),
    )
    return commande.agg(F.min("datecom").alias("dmin"), F.max(last).alias("dmax"))


def calendar(days: DataFrame, col: str = "date_jour") -> DataFrame:
    """Calendar attributes of a column of dates (ISO week with calendar year)."""
    d = F.col(col)
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("date_jour"),
        F.year(d).alias("annee"),
        F.quarter(d).alias("trimestre"),
        F.month(d).alias("mois"),
        F.weekofyear(d).alias("semaine_iso"),
        F.dayofmonth(d).alias("jour_mois"),
        iso_weekday(d).alias("jour_semaine_iso"),
    )


def dim_date(commande: DataFrame) -> DataFrame:
    """One row per day between the bounds of E1.

    Its size follows the span of the dates, never the number of orders. A
    stray date makes it longer but fails nothing.
    """
    days = date_bounds(commande).select(
        F.explode(F.sequence("dmin", "dmax", F.expr("INTERVAL 1 DAY"))).alias("date_jour"))
    return calendar(days)


CLIENT_COLS = ("codecli", "societe", "contact", "fonction", "ville", "region", "pays", "codepostal")


def client_rows(client: DataFrame, sentinels: Iterable[str] = (SENTINEL,)) -> DataFrame:
    """E4 without the key: customers, every attribute but the code cleaned."""
    s = tuple(sentinels)
    return client.select("codecli", *[clean(c, s).alias(c) for c in CLIENT_COLS[1:]])


def dim_client(client: DataFrame, sentinels: Iterable[str] = (SENTINEL,)) -> DataFrame:
    """Customers with their hashed key."""
    return client_rows(client, sentinels).select(natural_key("codecli").alias("client_key"), *CLIENT_COLS)


def dim_employe(employe: DataFrame, sentinels: Iterable[str] = (SENTINEL,)) -> DataFrame:
    """E5: employees; only the address fields are cleaned."""
    s = tuple(sentinels)
    return employe.select(
        F.col("noemp").cast("bigint").alias("employe_key"),
        "noemp", "nom", "prenom", "fonction",
        *[clean(c, s).alias(c) for c in ("ville", "region", "pays")],
        "rendcomptea",
    )


def dim_transporteur(transporteur: DataFrame) -> DataFrame:
    """Carriers, as they are."""
    return transporteur.select(
        F.col("notran").cast("bigint").alias("transporteur_key"), "notran", "nomtran", "tel")


def clean_geo(sentinels: Iterable[str] = (SENTINEL,)) -> list:
    """The 4 delivery-address fields, cleaned."""
    s = tuple(sentinels)
    return [clean(c, s).alias(c) for c in GEO_COLS]


def geo_rows(commande: DataFrame, sentinels: Iterable[str] = (SENTINEL,)) -> DataFrame:
    """E7 without the key: distinct cleaned delivery addresses, NULLs
    grouping as equal. The DISTINCT is a partial aggregate per task first,
    so only distinct addresses are shuffled, however many orders share one."""
    return commande.select(clean_geo(sentinels)).distinct()


def dim_geo(commande: DataFrame, sentinels: Iterable[str] = (SENTINEL,)) -> DataFrame:
    """Delivery addresses with their hashed key (NULL-safe on all 4 fields)."""
    return geo_rows(commande, sentinels).select(natural_key(*GEO_COLS).alias("geo_key"), *GEO_COLS)


def dim_produit(produit: DataFrame, categorie: DataFrame, fournisseur: DataFrame,
                sentinels: Iterable[str] = (SENTINEL,)) -> DataFrame:
    """Product ⋈ category ⋈ supplier (both inner), denormalised.

    Carries the stock fields the reorder report needs and the supplier
    region; supplier fields are cleaned like the other dimensions.
    """
    s = tuple(sentinels)
    cat = categorie.select("codecateg", "nomcateg")
    four = fournisseur.select(
        "nofour",
        clean("societe", s).alias("fournisseur_societe"),
        clean("pays", s).alias("fournisseur_pays"),
        clean("region", s).alias("fournisseur_region"),
    )
    return (produit.join(cat, "codecateg").join(four, "nofour")
            .select(
                F.col("refprod").alias("produit_key"),
                "refprod", "nomprod",
                F.col("prixunit").alias("prixcatalogue"),
                "indisponible", "codecateg", "nomcateg", "nofour",
                "fournisseur_societe", "fournisseur_pays", "fournisseur_region",
                "unitesstock", "unitescom", "niveaureap",
            ))
