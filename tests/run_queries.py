"""Developer tool: run registered queries against their SQL. `python tests/run_queries.py [--sf 0.01] [names...]`"""

import argparse
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests import compare  # noqa: E402
import __spark_entry__ as entry  # noqa: E402
from plantflow.session import build_session  # noqa: E402

parser = argparse.ArgumentParser()
parser.add_argument("--sf", default="0.01")
parser.add_argument("--group-rows")
parser.add_argument("--plans", action="store_true", help="report plan nodes that would not scale")
parser.add_argument("names", nargs="*")
args = parser.parse_args()
sf_dir = args.sf if args.sf.startswith("/") else f"/root/testdata/sf{args.sf}"
spark = build_session("check", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
spark.sparkContext.setLogLevel("ERROR")
if args.group_rows:
    spark.conf.set("spark.plantflow.maxGroupRows", args.group_rows)
queries, sql = entry.queries(), entry.oracle_sql()
names = [n for n in queries if not args.names or any(n.startswith(p) for p in args.names)]
connection = compare.duck(sf_dir)
bad = []
for name in names:
    start = time.time()
    try:
        frame = queries[name](spark, sf_dir)
        if args.plans:
            plan = frame._jdf.queryExecution().executedPlan().toString()
            for smell in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython"):
                if smell in plan:
                    print("PLAN", name, smell, plan.count(smell))
            lines = plan.split("\n")
            for i, line in enumerate(lines):
                if "Exchange SinglePartition" in line and any(" Window " in x or "- Window" in x for x in lines[max(0, i - 3) : i]):
                    print("PLAN", name, "window over one partition")
        left = compare.spark_rows(frame)
        took = time.time() - start
        problem = None
        if name in sql:
            problem = compare.difference(left, compare.sql_rows(connection, sql[name]))
        verdict = "DIFF " + problem[:1200] if problem else ("ok" if name in sql else "ok (rows only)")
    except Exception as error:  # noqa: BLE001
        took, verdict = time.time() - start, "ERROR " + "".join(traceback.format_exception_only(error))[:1500]
        left = ([], [])
    if not verdict.startswith("ok"):
        bad.append(name)
    print(f"{name:32s} {took:6.2f}s rows={len(left[1]):6d} {verdict}", flush=True)
print("failed:", bad)
