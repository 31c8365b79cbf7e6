"""Period parameters P1–P4 and the date role R8.

* P1 ``Period``: restrict to years / quarters / months / ISO weeks.
* P2 grains: finance reports read by year / quarter / month, logistics
  by quarter / month / week. A coarser grain re-aggregates from the fact
  (distinct counts and averages are not additive across periods).
* R8 ``role``: which date of the order drives the period
  (order ``com``, ship ``env`` or target ``obj`` date).

No dimension is broadcast by hint. A year filter on the order date prunes
the facts' ``annee`` partitions and becomes a ``date_key`` range that
reaches the Parquet scan as a pushed filter. A filter without a year
(ISO week 53, every August, …) joins the filtered calendar.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERIOD_COLS = ("annee", "trimestre", "mois", "semaine_iso")

FINANCE_GRAINS: dict[str, tuple[str, ...]] = {
    "annee": ("annee",),
    "trimestre": ("annee", "trimestre"),
    "mois": ("annee", "trimestre", "mois"),
}
LOGISTICS_GRAINS: dict[str, tuple[str, ...]] = {
    "trimestre": ("annee", "trimestre"),
    "mois": ("annee", "trimestre", "mois"),
    "semaine": ("annee", "trimestre", "mois", "semaine_iso"),
}

ROLE_KEYS = {"com": "datecom_key", "env": "dateenv_key", "obj": "dateobj_key"}


def _as_list(v) -> list[int] | None:
    if v is None:
        return None
    if isinstance(v, (list, tuple, set, frozenset)):
        return sorted(v)
    return [v]


@dataclass(frozen=True)
class Period:
    """Each field is None (no filter), one value or a collection."""

    annee: int | Sequence[int] | None = None
    trimestre: int | Sequence[int] | None = None
    mois: int | Sequence[int] | None = None
    semaine_iso: int | Sequence[int] | None = None

    def calendar_filter(self) -> Column | None:
        cond = None
        for name in PERIOD_COLS:
            vals = _as_list(getattr(self, name))
            if vals is not None:
                c = F.col(name).isin(vals)
                cond = c if cond is None else cond & c
        return cond

    def key_range_filter(self, key_col: str) -> Column | None:
        """Range predicates on a YYYYMMDD key implied by years / months."""
        years = _as_list(self.annee)
        if years is None:
            return None
        months = _as_list(self.mois)
        k = F.col(key_col)
        cond = None
        for y in years:
            if months is None:
                parts = [k.between(y * 10000 + 101, y * 10000 + 1231)]
            else:
                parts = [k.between(y * 10000 + m * 100 + 1, y * 10000 + m * 100 + 31) for m in months]
            for p in parts:
                cond = p if cond is None else cond | p
        return cond


def finance_grain(grain: str) -> tuple[str, ...]:
    try:
        return FINANCE_GRAINS[grain]
    except KeyError:
        raise ValueError(f"finance grain must be one of {sorted(FINANCE_GRAINS)}, got {grain!r}") from None


def logistics_grain(grain: str) -> tuple[str, ...]:
    try:
        return LOGISTICS_GRAINS[grain]
    except KeyError:
        raise ValueError(f"logistics grain must be one of {sorted(LOGISTICS_GRAINS)}, got {grain!r}") from None


def with_calendar(fact: DataFrame, dim_temps: DataFrame, key_col: str, cols: Sequence[str],
                  period: Period | None = None, order_date_key: bool = True, how: str = "inner") -> DataFrame:
    """Attach calendar columns ``cols`` of ``fact[key_col]``, filtered by ``period``.

    ``order_date_key`` says ``key_col`` is the order date, whose year is
    the facts' ``annee`` partition column (static partition pruning).
    """
    cal = dim_temps.select(F.col("date_key").alias(key_col), *[c for c in cols if c != key_col])
    if period is not None:
        cf = period.calendar_filter()
        if cf is not None:
            cal = cal.filter(cf)
        kf = period.key_range_filter(key_col)
        if kf is not None:
            fact = fact.filter(kf)
        years = _as_list(period.annee)
        if years is not None and order_date_key and "annee" in fact.columns:
            fact = fact.filter(F.col("annee").isin(years))
    if "annee" in fact.columns and "annee" in cols:
        fact = fact.drop("annee")
    return fact.join(cal, key_col, how)
