"""Declared schemas of the source (OLTP) tables and fixed values.

Nothing here is inferred: every source is read with one of these
StructTypes. Integer business keys that grow with the data (order,
product, supplier, category) are BIGINT so that a 100 TB load cannot
overflow them; small reference keys (employee, carrier) stay INT.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values that must equal the source system's conventions ---------
# Placeholder the source system writes instead of NULL; cleaned at load.
SENTINEL = "unknown_value_please_contact_support"
# Label shown instead of a NULL dimension member in the period reports.
UNKNOWN_LABEL = "Non renseigné"
# Prefix of detail rows under a subtotal row.
DETAIL_PREFIX = "  - "
# Subtotal / detail levels of the F2 and F6 reports.
LEVEL_SUBTOTAL = 1
LEVEL_DETAIL = 2
# ---------------------------------------------------------------------------

S = T.StringType()
I = T.IntegerType()
L = T.LongType()
D = T.DateType()


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


CATEGORIE = T.StructType([_f("codecateg", L, False), _f("nomcateg", S, False), _f("description", S)])

FOURNISSEUR = T.StructType(
    [_f("nofour", L, False)]
    + [_f(c, S) for c in ("societe", "contact", "fonction", "adresse", "ville", "region",
                           "codepostal", "pays", "tel", "fax", "pageaccueil")]
)

CLIENT = T.StructType(
    [_f("codecli", S, False)]
    + [_f(c, S) for c in ("societe", "contact", "fonction", "adresse", "ville", "region",
                           "codepostal", "pays", "tel", "fax")]
)

EMPLOYE = T.StructType([
    _f("noemp", I, False), _f("nom", S), _f("prenom", S), _f("fonction", S), _f("titrecourtoisie", S),
    _f("datenaissance", D), _f("dateembauche", D), _f("adresse", S), _f("ville", S), _f("region", S),
    _f("codepostal", S), _f("pays", S), _f("teldom", S), _f("extension", I), _f("rendcomptea", I),
])

TRANSPORTEUR = T.StructType([_f("notran", I, False), _f("nomtran", S), _f("tel", S)])

PRODUIT = T.StructType([
    _f("refprod", L, False), _f("nomprod", S), _f("nofour", L, False), _f("codecateg", L, False),
    _f("qteparunit", S), _f("prixunit", T.DecimalType(10, 2)), _f("unitesstock", I), _f("unitescom", I),
    _f("niveaureap", I), _f("indisponible", I),
])

COMMANDE = T.StructType([
    _f("nocom", L, False), _f("codecli", S, False), _f("noemp", I, False), _f("datecom", D, False),
    _f("dateobjliv", D), _f("dateenv", D), _f("notran", I), _f("port", T.DecimalType(10, 2)),
    _f("destinataire", S), _f("adrliv", S), _f("villeliv", S), _f("regionliv", S),
    _f("codepostalliv", S), _f("paysliv", S),
])

DETAILCOMMANDE = T.StructType([
    _f("nocom", L, False), _f("refprod", L, False), _f("prixunit", T.DecimalType(10, 2), False),
    _f("qte", I, False), _f("remise", T.DecimalType(3, 2)),
])

OLTP_SCHEMAS: dict[str, T.StructType] = {
    "categorie": CATEGORIE,
    "fournisseur": FOURNISSEUR,
    "client": CLIENT,
    "employe": EMPLOYE,
    "transporteur": TRANSPORTEUR,
    "produit": PRODUIT,
    "commande": COMMANDE,
    "detailcommande": DETAILCOMMANDE,
}

# Money types of the mart.
AMOUNT = T.DecimalType(18, 2)
RATE = T.DecimalType(5, 4)

# --- Fixed values of the report layer ---------------------------------------
# Direction of the ship-vs-target gap (negative = early, positive = late).
GAP_EARLY = "avance"
GAP_ON_TIME = "a l'heure"
GAP_LATE = "retard"
# Date roles of an order.
DATE_ROLES = ("com", "env", "obj")
