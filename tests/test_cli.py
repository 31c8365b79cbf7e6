"""Command line: refresh, report with a period, checks."""

from __future__ import annotations

import os

from salesmart.__main__ import main
from salesmart.sources.files import write_oltp


def test_cli_refresh_report_check(spark, edge_oltp, tmp_root, capsys):
    write_oltp(edge_oltp, f"{tmp_root}/oltp")
    assert main(["refresh", "--oltp", f"{tmp_root}/oltp", "--mart", f"{tmp_root}/mart"]) == 0
    assert "fait_ventes 8" in capsys.readouterr().out
    assert main(["report", "f3_revenue_country", "--mart", f"{tmp_root}/mart", "--annee", "2016",
                 "--grain", "annee", "--csv", f"{tmp_root}/f3"]) == 0
    rows = spark.read.option("header", True).csv(f"{tmp_root}/f3").collect()
    assert {r.annee for r in rows} == {"2016"} and len(rows) == 2
    assert main(["report", "vl2_reorder", "--mart", f"{tmp_root}/mart", "--oltp", f"{tmp_root}/oltp"]) == 0
    assert main(["check", "--oltp", f"{tmp_root}/oltp", "--mart", f"{tmp_root}/mart"]) == 0
    out = capsys.readouterr().out
    assert "dq_orders_without_lines" in out and os.path.isdir(f"{tmp_root}/f3")
