"""salesmart — a sales & delivery star-schema mart on Spark.

Load (sources → star schema), finance / logistics reports, a report
layer (period, slicers, KPIs, top-N) and data-quality checks, all as
lazy DataFrame plans.
"""

from salesmart.plans.mart import build_mart, read_mart, refresh, write_mart
from salesmart.plans.model import Mart, Oltp
from salesmart.plans.period import Period

__all__ = ["Mart", "Oltp", "Period", "build_mart", "read_mart", "refresh", "write_mart"]
