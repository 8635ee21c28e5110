"""Run every registered query once and print row counts and timings."""
import os
import sys
import time
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from rewardlake.session import get_session
from rewardlake.plans.catalog import REGISTRY

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
only = sys.argv[2].split(",") if len(sys.argv) > 2 else None
spark = get_session("local[8]", 8)
bad = []
for name, fn in REGISTRY.items():
    if only and name not in only:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        n = df.count()
        print(f"{name:28s} rows={n:7d} {time.time()-t:6.2f}s cols={df.columns}", flush=True)
    except Exception as e:  # noqa
        bad.append(name)
        print(f"{name:28s} FAILED {type(e).__name__}: {str(e)[:600]}", flush=True)
print("FAILED:", bad)
