"""Command line: ``python -m salesmart <command>`` (or ``spark-submit``).

    list                                     names of all reports and checks
    refresh --oltp DIR --mart ROOT [--incremental]
    report NAME --mart ROOT [--oltp DIR] [--annee Y] [--trimestre Q] [--mois M]
                [--semaine W] [--grain G] [--csv OUT] [--show N]
    check --oltp DIR --mart ROOT             data-quality checks Q1–Q8

Source tables are read from ``--oltp`` (one Parquet folder per table, see
``sources.files.read_oltp``); the mart is the current version under
``--mart`` written by ``refresh``.
"""

from __future__ import annotations

import argparse
import inspect
import sys

from salesmart.plans.mart import current_mart, refresh
from salesmart.plans.period import Period
from salesmart.plans.publish import export_csv
from salesmart.registry import OPERATORS, apply
from salesmart.session import get_spark
from salesmart.sources.files import read_oltp

CHECKS = [n for n in OPERATORS if n.startswith("dq_")]


def _report(name: str, oltp, mart, period: Period | None, grain: str | None):
    kind, fn = OPERATORS[name]
    params = inspect.signature(fn).parameters
    if kind == "mart" and (period is not None or grain is not None):
        kwargs = {}
        if period is not None:
            if "period" not in params:
                raise SystemExit(f"{name} takes no period filter")
            kwargs["period"] = period
        if grain is not None:
            if "grain" not in params:
                raise SystemExit(f"{name} takes no grain")
            kwargs["grain"] = grain
        return fn(mart, **kwargs)
    return apply(name, oltp, mart)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="salesmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    r = sub.add_parser("refresh")
    r.add_argument("--oltp", required=True)
    r.add_argument("--mart", required=True)
    r.add_argument("--incremental", action="store_true")
    q = sub.add_parser("report")
    q.add_argument("name", choices=sorted(OPERATORS))
    q.add_argument("--mart", required=True)
    q.add_argument("--oltp")
    for f in ("annee", "trimestre", "mois", "semaine"):
        q.add_argument(f"--{f}", type=int)
    q.add_argument("--grain")
    q.add_argument("--csv")
    q.add_argument("--show", type=int, default=20)
    c = sub.add_parser("check")
    c.add_argument("--oltp", required=True)
    c.add_argument("--mart", required=True)
    a = ap.parse_args(argv)

    if a.cmd == "list":
        print("\n".join(OPERATORS))
        return 0
    spark = get_spark(app_name=f"salesmart-{a.cmd}")
    if a.cmd == "refresh":
        mart = refresh(spark, read_oltp(spark, a.oltp), a.mart, incremental=a.incremental)
        for name, df in mart.tables().items():
            print(name, df.count())
        return 0
    mart = current_mart(spark, a.mart)
    if mart is None:
        raise SystemExit(f"no mart under {a.mart}: run refresh first")
    oltp = read_oltp(spark, a.oltp) if a.oltp else None
    if a.cmd == "check":
        for name in CHECKS:
            print(f"== {name}")
            apply(name, oltp, mart).show(100, truncate=False)
        return 0
    if OPERATORS[a.name][0] != "mart" and oltp is None:
        raise SystemExit(f"{a.name} reads the source tables: give --oltp")
    period = None
    if any(v is not None for v in (a.annee, a.trimestre, a.mois, a.semaine)):
        period = Period(annee=a.annee, trimestre=a.trimestre, mois=a.mois, semaine_iso=a.semaine)
    df = _report(a.name, oltp, mart, period, a.grain)
    if a.csv:
        export_csv(df, a.csv)
    else:
        df.show(a.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
