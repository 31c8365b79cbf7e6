"""E18, incremental: only the years that changed are written; the result is that of a full rebuild."""

from __future__ import annotations

import glob
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mart_samples import D, day, edge_rows, make_oltp
from salesmart.operators import facts
from salesmart.plans import mart as plans
from salesmart.plans.mart import build_mart, current_mart, expire_versions, refresh, year_prints


def same(a, b) -> bool:
    return a.select(b.columns).exceptAll(b).isEmpty() and b.exceptAll(a.select(b.columns)).isEmpty()


def assert_rebuilt(mart, oltp):
    full = build_mart(oltp)
    for name in ("fait_livraisons", "fait_ventes"):
        assert same(getattr(mart, name), getattr(full, name)), name


def fact_files(root: str) -> dict[str, float]:
    return {p: os.path.getmtime(p) for p in glob.glob(f"{root}/fait_*/load=*/annee=*/*.parquet")}


def years_of(files) -> set[str]:
    return {p.split("annee=")[1].split("/")[0] for p in files}


def test_a_batch_of_one_year_leaves_the_other_years_files(spark, tmp_root):
    rows = edge_rows()
    first, batch = make_oltp(spark, **rows), edge_rows()
    refresh(spark, first, tmp_root)
    before = fact_files(tmp_root)
    assert years_of(before) == {"2014", "2016"}
    batch["detailcommande"].append(dict(nocom=106, refprod=10, prixunit=D("2.00"), qte=3, remise=D("0.00")))
    second = make_oltp(spark, **batch)
    mart = refresh(spark, second, tmp_root, incremental=True)
    after = fact_files(tmp_root)
    assert {p: t for p, t in after.items() if p in before} == before          # nothing touched
    assert years_of(set(after) - set(before)) == {"2016"}                     # one year written
    assert sorted(f["annee"] for f in plans._newest(spark, tmp_root)["facts"]) == [2014, 2014, 2016, 2016]
    assert_rebuilt(mart, second)
    assert_rebuilt(current_mart(spark, tmp_root), second)
    loads = {f["annee"]: f["load"] for f in plans._newest(spark, tmp_root)["facts"]}
    assert loads[2014] != loads[2016]


def test_nothing_changed_writes_no_fact(spark, edge_oltp, tmp_root):
    refresh(spark, edge_oltp, tmp_root)
    before = fact_files(tmp_root)
    again = replace(edge_oltp, detailcommande=edge_oltp.detailcommande.repartition(5), commande=edge_oltp.commande.repartition(3))
    mart = refresh(spark, again, tmp_root, incremental=True)                    # the rows' order does not count
    assert fact_files(tmp_root) == before
    assert_rebuilt(mart, edge_oltp)


@pytest.mark.parametrize("named", [False, True])
def test_changed_headers_lines_and_years(spark, tmp_root, named):
    """A changed header, a line that went, an order that moved to another year and a year without orders."""
    rows = edge_rows()
    refresh(spark, make_oltp(spark, **rows), tmp_root)
    new = edge_rows()
    new["commande"] = [dict(r, datecom=day("2017-03-01")) if r["nocom"] == 105 else dict(r, port=D("9.00")) if r["nocom"] == 100 else r for r in new["commande"] if r["nocom"] != 107]
    new["detailcommande"] = [r for i, r in enumerate(new["detailcommande"]) if i != 2]
    oltp = make_oltp(spark, **new)
    # orders that are no more, or whose old year is another one, are not to be seen in the sources: 2016 is named by order 100
    changed = spark.createDataFrame([(100,), (105,)], "nocom long") if named else None
    mart = refresh(spark, oltp, tmp_root, incremental=True, changed=changed)
    assert_rebuilt(mart, oltp)
    assert {r.annee for r in mart.fait_ventes.select("annee").distinct().collect()} == {2014, 2016, 2017}
    gone = make_oltp(spark, **dict(new, commande=[r for r in new["commande"] if r["nocom"] != 101]))
    mart = refresh(spark, gone, tmp_root, incremental=True)
    assert_rebuilt(mart, gone)
    assert {f["annee"] for f in plans._newest(spark, tmp_root)["facts"]} == {2016, 2017}


def test_a_new_member_brings_back_its_orders(spark, tmp_root):
    """An order of an unknown customer, a line of an unknown product and an order of an unknown carrier appear once these are known."""
    rows = edge_rows()
    rows["commande"].append(dict(nocom=108, codecli="C9", noemp=1, datecom=day("2013-05-05"), notran=9, port=D("1.00")))
    rows["commande"].append(dict(nocom=109, codecli="C1", noemp=1, datecom=day("2012-05-05"), notran=9, port=D("1.00")))
    rows["detailcommande"].append(dict(nocom=108, refprod=10, prixunit=D("2.00"), qte=3, remise=D("0.00")))
    oltp = make_oltp(spark, **rows)
    assert refresh(spark, oltp, tmp_root).fait_livraisons.where("annee = 2013").isEmpty()
    before = fact_files(tmp_root)
    rows["client"].append(dict(codecli="C9", societe="Soc 9"))
    rows["transporteur"].append(dict(notran=9, nomtran="Nine"))
    oltp = make_oltp(spark, **rows)
    nobody = spark.createDataFrame([], "nocom long")
    mart = refresh(spark, oltp, tmp_root, incremental=True, changed=nobody)     # also where no order is named
    assert_rebuilt(mart, oltp)
    assert mart.fait_ventes.where("annee = 2013").count() == 1
    assert years_of(set(fact_files(tmp_root)) - set(before)) == {"2012", "2013", "2016"}
    rows["produit"].append(dict(refprod=77, nomprod="P", nofour=1, codecateg=1, prixunit=D("1.00")))
    mart = refresh(spark, make_oltp(spark, **rows), tmp_root, incremental=True)
    assert_rebuilt(mart, make_oltp(spark, **rows))


def test_expiry_keeps_years_that_a_kept_version_lists(spark, tmp_root):
    rows = edge_rows()
    refresh(spark, make_oltp(spark, **rows), tmp_root)
    for qte in (3, 4):
        rows["detailcommande"].append(dict(nocom=106, refprod=10, prixunit=D("2.00"), qte=qte, remise=D("0.00")))
        refresh(spark, make_oltp(spark, **rows), tmp_root, incremental=True)
    assert len(expire_versions(spark, tmp_root, keep=1)) == 2
    assert_rebuilt(current_mart(spark, tmp_root), make_oltp(spark, **rows))
    kept = {tuple(f) for f in plans._newest(spark, tmp_root)["facts"]}
    on_disk = {(p.split("/")[-3], int(p.split("annee=")[1]), p.split("load=")[1].split("/")[0]) for p in glob.glob(f"{tmp_root}/fait_*/load=*/annee=*")}
    assert on_disk == kept and expire_versions(spark, tmp_root, keep=1) == []


def test_a_mart_of_nothing(spark, tmp_root):
    empty = make_oltp(spark)
    for incremental in (False, True):
        mart = refresh(spark, empty, tmp_root, incremental=incremental)
        assert mart.fait_ventes.isEmpty() and mart.fait_livraisons.isEmpty()
    mart = refresh(spark, make_oltp(spark, **edge_rows()), tmp_root, incremental=True)
    assert_rebuilt(mart, make_oltp(spark, **edge_rows()))


def test_an_order_without_a_date_has_a_year_of_its_own(spark, tmp_root):
    def oltp(rows):
        o = make_oltp(spark, **rows)
        return replace(o, commande=o.commande.withColumn("datecom", F.when(F.col("nocom") != 106, F.col("datecom"))))

    rows = edge_rows()
    refresh(spark, oltp(rows), tmp_root)
    before = fact_files(tmp_root)
    rows["detailcommande"].append(dict(nocom=106, refprod=10, prixunit=D("2.00"), qte=3, remise=D("0.00")))
    mart = refresh(spark, oltp(rows), tmp_root, incremental=True)
    assert_rebuilt(mart, oltp(rows))
    assert years_of(set(fact_files(tmp_root)) - set(before)) == {"__HIVE_DEFAULT_PARTITION__"}


def test_prints_see_values_that_change_places(spark):
    a, b = edge_rows(), edge_rows()
    b["commande"][0] = dict(b["commande"][0], villeliv=None, regionliv="Lille")
    a["commande"][0] = dict(a["commande"][0], villeliv="Lille", regionliv=None)
    assert set(year_prints(make_oltp(spark, **a)).collect()) != set(year_prints(make_oltp(spark, **b)).collect())
    assert all(r.n_lines >= 0 for r in year_prints(make_oltp(spark)).collect())


def test_line_keys_are_the_same_in_every_load(spark, edge_oltp, monkeypatch):
    """Equal lines get different keys, and the same ones whatever the tasks; many copies are written out by several tasks."""
    lines = edge_oltp.detailcommande
    many = lines.unionByName(lines).unionByName(lines.where("nocom = 100")).unionByName(lines)
    oltp = replace(edge_oltp, detailcommande=many)
    once = build_mart(oltp).fait_ventes
    assert once.select("ventes_key").distinct().count() == once.count() == 8 * 3 + 3
    other = replace(oltp, detailcommande=many.repartition(7, "prixunit"))
    assert same(build_mart(other).fait_ventes, once)
    monkeypatch.setattr(facts, "COPIES", 2)
    assert same(build_mart(oltp).fait_ventes, once)
    assert facts.numbered_lines(many).count() == many.count()
