"""Every registered query against its DuckDB oracle on the smallest test data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from mart_samples import SF0001
from oracle_compare import compare, duck
from salesmart.registry import OPERATORS

QUERIES = {name: entry.queries()[name] for name in OPERATORS}  # the library's own; others have their tests
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in OPERATORS}


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, SF0001, name, QUERIES[name], SQL.get(name))
    assert r["status"] == "match", r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[:4] == ["annee", "trimestre", "mois", "semaine_iso"]
