"""Run every registered query against its DuckDB oracle (local gate).

usage: python scripts/check_oracles.py [sf_dir] [name-substring ...]
"""
import json
import sys
import time

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

from oracle_harness import compare, duck  # noqa: E402

from starloom import get_session  # noqa: E402
from starloom.plans.catalog import oracle_sql, queries  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
filters = sys.argv[2:]
spark = get_session(master="local[8]", shuffle_partitions=8)
con = duck(sf)
qs, sqls = queries(), oracle_sql()
bad = 0
for name, fn in qs.items():
    if filters and not any(f in name for f in filters):
        continue
    t = time.time()
    try:
        r = compare(spark, sf, name, fn, sqls.get(name), con)
    except Exception as e:  # report and continue
        r = {"name": name, "status": f"error: {type(e).__name__}: {str(e)[:400]}"}
    r["sec"] = round(time.time() - t, 2)
    if r["status"] not in ("match", "rows-only"):
        bad += 1
    print(json.dumps(r, default=str)[:3000], flush=True)
print(f"non-matching: {bad}")
