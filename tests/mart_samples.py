"""Hand-made source rows and the test data folder, imported by the mart's tests.

Not in ``conftest.py``: test folders below this one have a conftest of their own,
and ``import conftest`` finds whichever was loaded last.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from salesmart.plans.model import Oltp
from salesmart.schema import OLTP_SCHEMAS, SENTINEL

SF0001 = "/root/testdata/sf0.001"


def make_oltp(spark, **tables: list[dict]) -> Oltp:
    """Source tables from hand-made rows (absent columns are NULL)."""
    dfs = {}
    for name, schema in OLTP_SCHEMAS.items():
        rows = [tuple(r.get(f.name) for f in schema.fields) for r in tables.get(name, [])]
        dfs[name] = spark.createDataFrame(rows, schema)
    return Oltp(**dfs)


def D(x: str) -> Decimal:
    return Decimal(x)


def day(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def edge_rows() -> dict[str, list[dict]]:
    """Edge cases: sentinel everywhere, literal 'unknown', NULL carrier and a
    carrier named like the NULL label, order without lines, line without
    header, unknown product, unknown customer, NULL freight, zero net total,
    1-cent freight over two equal lines, ISO-week corners, ship date before
    the calendar, two products sharing a name in one category."""
    S = SENTINEL
    return dict(
        categorie=[dict(codecateg=1, nomcateg="Boissons"), dict(codecateg=2, nomcateg="Desserts")],
        fournisseur=[
            dict(nofour=1, societe="Four A", pays="France", region="Nord"),
            dict(nofour=2, societe="Four B", pays=S, region=S),
        ],
        client=[
            dict(codecli="C1", societe="Soc 1", ville="Lille", region="Nord", pays="France", codepostal="59000"),
            dict(codecli="C2", societe=S, contact=S, ville=S, region="unknown", pays="Belgique", codepostal=S),
            dict(codecli="C3", societe="Soc 3", ville="Gand", region="Flandre", pays="Belgique"),
        ],
        employe=[
            dict(noemp=1, nom="Dupont", prenom="Jean", ville=S, region="unknown", pays="France"),
            dict(noemp=2, nom="Martin", prenom="Anne", rendcomptea=1),
        ],
        transporteur=[dict(notran=1, nomtran="Speedy"), dict(notran=2, nomtran="Non renseigné")],
        produit=[
            dict(refprod=10, nomprod="Thé", nofour=1, codecateg=1, prixunit=D("4.50"), unitesstock=10,
                 unitescom=5, niveaureap=20),
            dict(refprod=11, nomprod="Thé", nofour=2, codecateg=1, prixunit=D("3.00"), unitesstock=50,
                 unitescom=0, niveaureap=20),
            dict(refprod=12, nomprod="Gâteau", nofour=1, codecateg=2, prixunit=D("20.00"), unitesstock=1,
                 unitescom=1, niveaureap=None),
        ],
        commande=[
            # ISO week 53 of 2016 (a Friday), shipped 5 days early
            dict(nocom=100, codecli="C1", noemp=1, datecom=day("2016-01-01"), dateobjliv=day("2016-01-10"),
                 dateenv=day("2016-01-05"), notran=1, port=D("10.00"), paysliv="France", regionliv="Nord",
                 villeliv="Lille", codepostalliv="59000"),
            # ISO week 1 of 2015 but calendar year 2014, 3 days late, no carrier, no freight
            dict(nocom=101, codecli="C2", noemp=2, datecom=day("2014-12-29"), dateobjliv=day("2015-01-02"),
                 dateenv=day("2015-01-05"), notran=None, port=None, paysliv="Belgique", regionliv="unknown",
                 villeliv=S, codepostalliv=S),
            # a Sunday, no target date, carrier literally named "Non renseigné", 1-cent freight
            dict(nocom=102, codecli="C1", noemp=1, datecom=day("2016-01-03"), dateobjliv=None,
                 dateenv=day("2016-01-03"), notran=2, port=D("0.01"), paysliv="France", regionliv=S,
                 villeliv="Lille", codepostalliv="59000"),
            # order without lines
            dict(nocom=103, codecli="C3", noemp=2, datecom=day("2016-01-02"), notran=1, port=D("3.00"),
                 paysliv="Belgique", regionliv="Flandre", villeliv="Gand"),
            # unknown customer: dropped from both facts
            dict(nocom=104, codecli="C9", noemp=1, datecom=day("2016-01-02"), notran=1, port=D("1.00")),
            # every line fully discounted: net total 0
            dict(nocom=105, codecli="C3", noemp=2, datecom=day("2016-01-06"), dateobjliv=day("2016-01-08"),
                 dateenv=day("2016-01-08"), notran=1, port=D("7.00"), paysliv="Belgique",
                 regionliv="Flandre", villeliv="Gand"),
            # NULL carrier in the same month as the carrier named "Non renseigné"
            dict(nocom=106, codecli="C1", noemp=2, datecom=day("2016-01-04"), notran=None, port=D("5.00"),
                 paysliv="France", regionliv="Nord", villeliv="Lille", codepostalliv="59000"),
            # shipped before the first order date: no calendar row for the ship date
            dict(nocom=107, codecli="C3", noemp=1, datecom=day("2016-01-05"), dateenv=day("2014-12-01"),
                 notran=1, port=D("1.00"), paysliv="Belgique", regionliv="Flandre", villeliv="Gand"),
        ],
        detailcommande=[
            dict(nocom=100, refprod=10, prixunit=D("4.50"), qte=10, remise=D("0.05")),
            dict(nocom=100, refprod=12, prixunit=D("20.00"), qte=1, remise=D("0.00")),
            dict(nocom=100, refprod=10, prixunit=D("4.50"), qte=2, remise=D("0.00")),   # repeats (100, 10)
            dict(nocom=100, refprod=77, prixunit=D("1.00"), qte=1, remise=D("0.00")),   # unknown product
            dict(nocom=101, refprod=11, prixunit=D("3.00"), qte=5, remise=D("0.10")),
            dict(nocom=102, refprod=10, prixunit=D("1.00"), qte=1, remise=D("0.00")),
            dict(nocom=102, refprod=11, prixunit=D("1.00"), qte=1, remise=D("0.00")),
            dict(nocom=104, refprod=10, prixunit=D("1.00"), qte=1, remise=D("0.00")),
            dict(nocom=105, refprod=12, prixunit=D("5.00"), qte=2, remise=D("1.00")),
            dict(nocom=106, refprod=12, prixunit=D("10.00"), qte=1, remise=D("0.00")),
            dict(nocom=999, refprod=10, prixunit=D("1.00"), qte=1, remise=D("0.00")),   # no header
        ],
    )
