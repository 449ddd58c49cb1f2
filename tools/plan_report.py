"""Write PLANS.md: the physical-plan shape of every registered query.

Usage: python tools/plan_report.py [data_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "hash exch": r"Exchange hashpartitioning",
    "range exch": r"Exchange rangepartitioning",
    "single exch": r"Exchange SinglePartition",
    "bcast": r"BroadcastExchange",
    "SMJ": r"SortMergeJoin",
    "BHJ": r"BroadcastHashJoin",
    "window": r"\bWindow \[",
    "hash agg": r"HashAggregate\(",
    "top-k": r"TakeOrderedAndProject",
    "subquery": r"Subquery subquery",
}


def main(argv):
    data_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from shoplens.session import get_spark
    from shoplens import registry
    spark = get_spark("local[8]", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{data_dir}` (final adaptive plan, after "
          "the query ran). Counts of operators per plan; `scan cols` lists the columns "
          "each Parquet scan reads. `single exch` comes from global aggregates (one partial "
          "row per task) and windows over small results (weeks).\n")
    print("| query | " + " | ".join(PATTERNS) + " | scan cols |")
    print("| --- | " + " | ".join("---" for _ in PATTERNS) + " | --- |")
    for name, fn in registry.queries().items():
        buf = io.StringIO()
        df = fn(spark, data_dir)
        df.collect()                    # the plan as executed
        with contextlib.redirect_stdout(buf):
            df.explain()
        plan = buf.getvalue().split("== Initial Plan ==")[0]
        counts = [str(len(re.findall(p, plan))) for p in PATTERNS.values()]
        scans = []
        for line in plan.splitlines():
            loc = re.search(r"Location: \w+(?:\([^)]*\))?\[([^\],]+)", line)
            schema = re.search(r"ReadSchema: struct<(.*)>", line)
            if loc and schema:
                table = os.path.basename(loc.group(1).rstrip("/")).replace(".parquet", "")
                cols = [c.split(":")[0] for c in re.split(r",(?![^<]*>)", schema.group(1))]
                scans.append(f"{table}({','.join(cols)})")
        scans = sorted(set(scans))
        print(f"| `{name}` | " + " | ".join(counts) + f" | {' '.join(scans)} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
