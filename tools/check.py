"""Run registered queries against their SQL twins: check.py SF_DIR [prefix ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import oracle  # noqa: E402

from kerbside.plans import catalog  # noqa: E402
from kerbside.session import build_session  # noqa: E402

sf_dir, prefixes = sys.argv[1], tuple(sys.argv[2:])
spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g"})
spark.sparkContext.setLogLevel("ERROR")
con = oracle.connect(sf_dir)
sqls = catalog.oracle_sql()
bad = 0
for name, fn in catalog.queries().items():
    if prefixes and not name.startswith(prefixes):
        continue
    start = time.time()
    try:
        df = fn(spark, sf_dir)
        if name in sqls:
            problem = oracle.differences(df, con, sqls[name])
        else:
            problem = None if df.count() > 0 else "no rows"
    except Exception as error:  # report and go on with the next query
        problem = f"{type(error).__name__}: {str(error)[:900]}"
    bad += problem is not None
    print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
print("bad:", bad)
