"""Compare each registered Spark query with its DuckDB oracle.

Mimics the driver's check: row count, column names, and an
order-insensitive comparison of exact values (columns sorted by name).
Run as a script: ``python tests/oracle_compare.py [sf_dir] [names...]``.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return f"D{v.normalize()}"
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "smallint": "SMALLINT", "boolean": "BOOLEAN", "float": "FLOAT"}


def _duck_type(spark_type: str) -> str:
    if spark_type.startswith("decimal"):
        return spark_type.upper()
    return SPARK_TO_DUCK.get(spark_type, spark_type.upper())


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res.update(oracle_rows=len(d_rows), oracle_sec=round(time.time() - t1, 2))
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"columns differ: spark={s_cols} oracle={d_cols}"
        return res
    s_types = {c: _duck_type(t) for c, t in df.dtypes}
    d_types = {c[0]: str(c[1]) for c in cur.description}
    bad_types = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if bad_types:
        res["status"] = f"types differ: {bad_types}"
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if len(a) != len(b):
        res["status"] = "row count differs"
    elif a == b:
        res["status"] = "match"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        res["status"] = f"values differ in {len(diff)} rows, e.g. spark={diff[0][0]} oracle={diff[0][1]}"
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from salesmart.session import get_spark

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(entry.queries())
    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, sf_dir, n, qs[n], sqls.get(n))
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        ok = r["status"] in ("match", "no-oracle")
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:30s} {r.get('spark_rows', '-'):>7} {r.get('oracle_rows', '-'):>7} "
              f"{r.get('spark_sec', '-'):>6}s  {r['status'] if not ok else r['status']}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
