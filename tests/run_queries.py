"""Run queries against their SQL and print timings: ``python tests/run_queries.py [sf] [name ...]``."""

import os
import sys
import time
import traceback

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from compare import connect, differences

import __spark_entry__ as contract
from tableferry.session import build_session

sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
spark = build_session(
    "queries",
    **{
        "spark.master": "local[8]",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
    },
)
spark.sparkContext.setLogLevel("ERROR")
con = connect(sf_dir)
oracles = contract.oracle_sql()
failed = 0
for name, run in contract.queries().items():
    if len(sys.argv) > 2 and name not in sys.argv[2:]:
        continue
    started = time.time()
    try:
        frame = run(spark, sf_dir)
        problems = differences(frame, con, oracles[name]) if name in oracles else [] if frame.count() else ["no rows"]
    except Exception as error:
        traceback.print_exc(limit=-3)
        problems = [str(error)[:500]]
    failed += bool(problems)
    state, note = "FAIL" if problems else "ok  ", "" if name in oracles else "rows only"
    print(f"{state} {name:32s} {time.time() - started:6.2f}s {note}", *problems, flush=True)
print("failed", failed)
