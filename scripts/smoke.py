"""Run every registered query once and print rows / seconds / schema."""
import sys
import time

from salesmart.registry import QUERIES
from salesmart.session import get_spark

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
only = sys.argv[2:] or list(QUERIES)
spark = get_spark("local[8]", 8)
for name in only:
    t = time.time()
    try:
        df = QUERIES[name](spark, sf)
        n = df.count()
        print(f"{name:32s} {n:7d} {time.time()-t:6.2f}s {df.dtypes}", flush=True)
    except Exception as e:  # noqa: BLE001
        print(f"{name:32s} FAIL {type(e).__name__}: {str(e)[:300]}", flush=True)
