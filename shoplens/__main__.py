"""Command line: ``python -m shoplens RAW_DIR OUT_DIR [options]``.

Runs the incremental ingest, staging, facts, marts and validation checks
(``plans.warehouse.run_pipeline``) and prints the per-step seconds and the
check results.  ``spark-submit`` users pass the same arguments.
"""

from __future__ import annotations

import argparse
import json
import sys


def parse_args(argv):
    p = argparse.ArgumentParser(prog="shoplens", description=__doc__.splitlines()[0])
    p.add_argument("raw_dir", help="where the event CSV files arrive")
    p.add_argument("out_dir", help="where tables are written; shared storage on a cluster")
    # These four options are the public command line.
    p.add_argument("--full-refresh", action="store_true",
                   help="forget which files are done and start a new generation")
    p.add_argument("--sample-weeks", type=int, default=None,
                   help="from each file, events up to N weeks after its first day")
    p.add_argument("--sample-days", type=int, default=None,
                   help="build staging from the N earliest dates present")
    p.add_argument("--check", default="all", help="one validation by name, or all")
    p.add_argument("--threads", type=int, default=4, help="how many marts are built at a time")
    p.add_argument("--files-per-batch", type=int, default=1,
                   help="files cleaned and written in one job")
    p.add_argument("--mode", choices=("replace", "per_file"), default="replace",
                   help="whether a date belongs to its last file or to all of them")
    p.add_argument("--rebuild", choices=("touched", "all"), default="touched",
                   help="rewrite the dates that changed, or every layer")
    p.add_argument("--stream", action="store_true", help="take the files in as a stream")
    return p.parse_args(argv)


def main(argv=None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    from shoplens.plans.warehouse import run_pipeline
    from shoplens.session import get_spark
    spark = get_spark()
    result = run_pipeline(spark, args.raw_dir, args.out_dir, full_refresh=args.full_refresh,
                          sample_weeks=args.sample_weeks, sample_days=args.sample_days,
                          threads=args.threads, check=args.check,
                          files_per_batch=args.files_per_batch, mode=args.mode,
                          rebuild=args.rebuild, stream=args.stream)
    failed = {k: repr(v) for k, v in result["checks"].items() if isinstance(v, Exception)}
    print(json.dumps({"status": result["status"], "batches": result["batches"],
                      "total_rows": result["total_rows"], "rebuilt": result["rebuilt"],
                      "files": {f["file"]: f["processed_rows"] for f in result["files"]},
                      "seconds": {k: round(v, 3) for k, v in result["seconds"].items()},
                      "tables": result["tables"], "failed_checks": failed}))
    for name, rows in result["checks"].items():
        if not isinstance(rows, Exception):
            print(f"-- {name}")
            for r in rows:
                print("  ", r.asDict())
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
