"""Column expressions (pure ``pyspark.sql.functions`` compositions, JVM-side)."""

from salesmart.functions.cleaning import clean
from salesmart.functions.keys import date_key, iso_weekday, natural_key
from salesmart.functions.money import avg_exact, pct_round2, share_round2, to_money

__all__ = [
    "clean", "date_key", "iso_weekday", "natural_key",
    "avg_exact", "pct_round2", "share_round2", "to_money",
]
