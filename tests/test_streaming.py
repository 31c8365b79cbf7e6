"""Refresh procedure as a file stream (CSV landing folder → sources → mart → checks)."""

from __future__ import annotations

import os

from mart_samples import edge_rows, make_oltp
from salesmart.plans.mart import current_mart
from salesmart.sources.files import write_oltp
from salesmart.streaming.refresh_stream import read_imported_files, read_rejected, start_refresh_stream


def _csv(path: str, lines: list[dict]) -> None:
    with open(path, "w") as f:
        f.write("nocom;refprod;prixunit;qte;remise\n")
        for r in lines:
            f.write(f"{r['nocom']};{r['refprod']};{r['prixunit']};{r['qte']};{r['remise']}\n")


def test_stream_imports_once_and_refreshes(spark, tmp_root):
    rows = edge_rows()
    lines = rows["detailcommande"]
    base = dict(rows, detailcommande=lines[:4])
    write_oltp(make_oltp(spark, **base), f"{tmp_root}/oltp")
    landing = f"{tmp_root}/landing"
    os.makedirs(landing)
    _csv(f"{landing}/a.csv", lines[4:8])
    _csv(f"{landing}/b.csv", lines[8:])
    ck = f"{tmp_root}/ck"
    q = start_refresh_stream(spark, landing, f"{tmp_root}/oltp", f"{tmp_root}/mart", checkpoint=ck)
    q.awaitTermination(300)
    mart = current_mart(spark, f"{tmp_root}/mart")
    assert mart.fait_ventes.count() == 8                 # same as loading all lines at once
    # a restart with no new file imports nothing twice
    q = start_refresh_stream(spark, landing, f"{tmp_root}/oltp", f"{tmp_root}/mart", checkpoint=ck)
    q.awaitTermination(300)
    assert current_mart(spark, f"{tmp_root}/mart").fait_ventes.count() == 8
    checks = spark.read.parquet(f"{tmp_root}/mart/_checks").collect()
    assert checks and all(r.commandes_oltp == 8 and r.commandes_dw == 7 for r in checks)


def _run(spark, root, checkpoint):
    q = start_refresh_stream(spark, f"{root}/landing", f"{root}/oltp", f"{root}/mart", checkpoint=checkpoint)
    q.awaitTermination(300)
    return current_mart(spark, f"{root}/mart").fait_ventes.count()


def test_lines_stay_when_a_file_leaves_and_checkpoints_change(spark, tmp_root):
    rows = edge_rows()
    lines = rows["detailcommande"]
    write_oltp(make_oltp(spark, **dict(rows, detailcommande=lines[:4])), f"{tmp_root}/oltp")
    os.makedirs(f"{tmp_root}/landing")
    _csv(f"{tmp_root}/landing/a.csv", lines[4:8])
    _run(spark, tmp_root, f"{tmp_root}/ck1")
    os.replace(f"{tmp_root}/landing/a.csv", f"{tmp_root}/a.csv")
    _csv(f"{tmp_root}/landing/b.csv", lines[8:])
    assert _run(spark, tmp_root, f"{tmp_root}/ck1") == 8          # both files' lines are there
    assert _run(spark, tmp_root, f"{tmp_root}/ck2") == 8          # a new checkpoint sees b.csv again: nothing twice
    incoming = spark.read.parquet(f"{tmp_root}/oltp/detailcommande_incoming")
    assert incoming.count() == len(lines) - 4


def test_broken_lines_and_replaced_files_are_reported(spark, tmp_root):
    """A broken line and the lines of a file put in another's place are set apart; the others load on."""
    rows = edge_rows()
    lines = rows["detailcommande"]
    write_oltp(make_oltp(spark, **dict(rows, detailcommande=lines[:4])), f"{tmp_root}/oltp")
    os.makedirs(f"{tmp_root}/landing")
    _csv(f"{tmp_root}/landing/a.csv", lines[4:8])
    with open(f"{tmp_root}/landing/a.csv", "a") as f:
        f.write("106;10;many;1;0.00\n")
    before = _run(spark, tmp_root, f"{tmp_root}/ck1")
    (broken,) = read_rejected(spark, f"{tmp_root}/oltp").collect()
    assert (broken.ligne, list(broken.regles)) == ("106;10;many;1;0.00", ["prixunit_lisible"])
    (file,) = read_imported_files(spark, f"{tmp_root}/oltp").collect()
    assert file.source_file.endswith("/landing/a.csv") and file.source_size == os.path.getsize(f"{tmp_root}/landing/a.csv")
    _csv(f"{tmp_root}/landing/a.csv", lines[4:7])
    os.utime(f"{tmp_root}/landing/a.csv", (4e9, 4e9))
    _csv(f"{tmp_root}/landing/b.csv", lines[8:])
    after = _run(spark, tmp_root, f"{tmp_root}/ck2")
    rejected = [r for r in read_rejected(spark, f"{tmp_root}/oltp").collect() if list(r.regles) == ["fichier_remplace"]]
    assert len(rejected) == 3 and after == 8 > before
    assert read_imported_files(spark, f"{tmp_root}/oltp").where("source_file LIKE '%a.csv'").count() == 2
