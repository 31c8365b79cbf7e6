"""Exact money arithmetic.

Amounts stay DECIMAL through every sum (exact, order independent) and are
turned into DOUBLE only at the report edge, so two engines or two plans
give bit-identical results. Averages are ``sum / count`` in DOUBLE, which
is what an exact AVG rounded to a double would give, instead of Spark's
decimal AVG that rounds at 6 digits first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_money(c: Column) -> Column:
    """Report-edge representation of an exact DECIMAL amount."""
    return c.cast("double")


def avg_exact(c: Column) -> Column:
    """AVG ignoring NULLs, NULL when there is no value (aggregate expression)."""
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))


def share_round2(part: Column, total: Column) -> Column:
    """ROUND(100 * part / NULLIF(total, 0), 2) for money amounts, HALF_UP.

    Operands are narrowed to DECIMAL(22,2) so Spark keeps 12 fraction
    digits in the quotient before the final rounding (no double rounding
    in practice); 22 digits still hold a 10^19 revenue.
    """
    p = part.cast("decimal(22,2)")
    t = F.nullif(total.cast("decimal(22,2)"), F.lit(0).cast("decimal(22,2)"))
    return F.round(p * F.lit(100).cast("decimal(3,0)") / t, 2).cast("double")


def pct_round2(num: Column, den: Column) -> Column:
    """ROUND(100.0 * num / NULLIF(den, 0), 2) for counts, HALF_UP."""
    n = num.cast("decimal(20,0)")
    d = F.nullif(den.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(n * F.lit(100).cast("decimal(5,0)") / d, 2).cast("double")
