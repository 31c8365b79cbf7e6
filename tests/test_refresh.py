"""E18 refresh: staged load, versions, idempotence, incremental dimensions."""

from __future__ import annotations

from salesmart.plans.mart import build_mart, current_mart, load_mart, refresh


def _same(a, b):
    cols = a.columns
    return a.select(cols).exceptAll(b.select(cols)).count() == 0 and b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_staged_load_equals_lazy_build(edge_oltp, tmp_root):
    staged = load_mart(edge_oltp, f"{tmp_root}/m")
    lazy = build_mart(edge_oltp)
    for name in staged.tables():
        assert _same(getattr(staged, name), getattr(lazy, name)), name


def test_refresh_twice_is_idempotent_and_switches_version(spark, edge_oltp, tmp_root):
    m1 = refresh(spark, edge_oltp, tmp_root)
    c1 = {n: df.count() for n, df in m1.tables().items()}
    m2 = refresh(spark, edge_oltp, tmp_root)
    assert {n: df.count() for n, df in m2.tables().items()} == c1
    for name in m1.tables():
        assert _same(getattr(m1, name), getattr(m2, name)), name
    cur = current_mart(spark, tmp_root)
    assert cur.fait_ventes.count() == c1["fait_ventes"]


def test_incremental_refresh_keeps_existing_members(spark, edge_oltp, tmp_root):
    refresh(spark, edge_oltp, tmp_root)
    m = refresh(spark, edge_oltp, tmp_root, incremental=True)
    assert m.dim_geo.count() == build_mart(edge_oltp).dim_geo.count()       # NULL members not duplicated
    assert m.dim_client.count() == 3


def test_staged_load_equals_lazy_build_on_test_data(spark, tmp_root):
    """The bench / production path (staged load) gives the tables the checked lazy plan gives."""
    from mart_samples import SF0001
    from salesmart.sources.testdata import load_oltp

    oltp = load_oltp(spark, SF0001)
    staged = load_mart(oltp, f"{tmp_root}/m")
    lazy = build_mart(oltp)
    for name in staged.tables():
        assert _same(getattr(staged, name), getattr(lazy, name)), name


def test_a_stray_date_makes_a_long_calendar(spark, tmp_root):
    import datetime as dt

    from mart_samples import edge_rows, make_oltp

    rows = edge_rows()
    rows["commande"][0] = dict(rows["commande"][0], dateobjliv=dt.date(2999, 1, 1))
    mart = load_mart(make_oltp(spark, **rows), f"{tmp_root}/m")
    assert mart.dim_temps.count() > 300_000 and mart.fait_livraisons.count() == 7


def test_a_crash_before_the_marker_leaves_the_previous_version(spark, edge_oltp, tmp_root, monkeypatch):
    import pytest

    from salesmart.plans import mart as plans

    assert plans.current_version(spark, tmp_root) is None
    refresh(spark, edge_oltp, tmp_root)
    first = plans.current_version(spark, tmp_root)

    def crash(*args, **options):
        raise RuntimeError("lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(plans, "_write_table", crash)
        refresh(spark, edge_oltp, tmp_root)
    assert plans.current_version(spark, tmp_root) == first
    refresh(spark, edge_oltp, tmp_root)
    second = plans.current_version(spark, tmp_root)
    assert second != first and plans.expire_versions(spark, tmp_root, keep=1) == [first]
    assert plans.current_version(spark, tmp_root) == second and current_mart(spark, tmp_root).fait_ventes.count() == 8
