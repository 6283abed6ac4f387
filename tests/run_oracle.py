"""Run every registered query against its oracle: python tests/run_oracle.py [sf_dir] [names...]"""

import json
import sys
import time

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

import __spark_entry__ as E  # noqa: E402
from oracle import compare, duck  # noqa: E402

from chunkwise.session import local_session  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = local_session(8)
con = duck(sf_dir)
qs, sqls = E.queries(), E.oracle_sql()
bad = 0
for name, fn in qs.items():
    if names and name not in names:
        continue
    t = time.time()
    try:
        df = fn(spark, sf_dir)
        if name in sqls:
            r = compare(df, con, sqls[name])
            ok = r["columns_match"] and r["hash_match"] and r["rows_spark"] == r["rows_oracle"]
        else:
            r = {"rows_spark": df.count()}
            ok = True
    except Exception as e:  # noqa: BLE001
        r, ok = {"error": repr(e)[:2000]}, False
    bad += not ok
    print(("OK  " if ok else "BAD ") + name, f"{time.time() - t:.1f}s", json.dumps(r, default=str)[:1500], flush=True)
print("failures:", bad)
