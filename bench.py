"""Benchmark: a full pipeline run at one scale, one JSON line on stdout.

Steps: ingest the raw stream to date-partitioned Parquet, materialize
fact_events, build fact_sessions and the six marts from it (concurrently,
BENCH_THREADS model threads), then run the checks, dashboards and KPIs on
the tables (concurrently as well).  After one warm-up run, BENCH_REPEAT
runs are measured; ``value`` is the median wall-clock total and
``queries`` the median of each step's own elapsed seconds (overlapping
inside the concurrent groups).

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_THREADS (default: BENCH_CPUS), BENCH_EVENT_LOG (default 1), BENCH_REPLICATE (default 1: copies of the event
stream with shifted ids).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from shoplens.plans import bi, checks  # noqa: E402
from shoplens.plans.warehouse import MaterializedWarehouse  # noqa: E402
from shoplens.session import get_spark  # noqa: E402
from shoplens.sources import fixture  # noqa: E402
from shoplens.sources.tables import read_table  # noqa: E402

LAYERS = ["fact", "sessions", "funnel", "retention", "growth", "rfm",
          "price_performance", "product_matrix"]
LAYER_NAMES = {"fact": "fact_events", "sessions": "fact_sessions", "funnel": "mart_funnel_daily",
               "retention": "mart_retention_cohort_weekly",
               "growth": "mart_category_growth_weekly", "rfm": "mart_rfm",
               "price_performance": "mart_price_performance",
               "product_matrix": "mart_product_matrix"}

READS = {
    "dq_report": lambda w: checks.model_dq_report(w),
    "check_row_counts": lambda w: checks.row_counts(w),
    "check_event_type_mix": lambda w: checks.event_type_mix(w.fact),
    "check_latest_funnel": lambda w: checks.latest_funnel(w.funnel),
    "check_top_categories": lambda w: checks.top_categories(w.growth),
    "bi_kpi_cards": lambda w: bi.kpi_cards(w.fact),
    "bi_daily_kpi": lambda w: bi.daily_kpi(w.fact),
    "bi_funnel_price": lambda w: bi.funnel_by_price(w.funnel),
    "bi_category_dropoff": lambda w: bi.category_dropoff(w.funnel),
    "bi_cohort_pivot": lambda w: bi.cohort_pivot(w.retention),
    "bi_contribution": lambda w: bi.growth_contribution(w.growth),
    "bi_weekly_monitor": lambda w: bi.weekly_monitor(w.fact),
    "bi_category_alerts": lambda w: bi.category_alerts(w.growth),
    "kpi_funnel": lambda w: bi.true_funnel(w.fact),
    "rfm_segment_summary": lambda w: bi.rfm_segment_summary(w.rfm),
    "headline_kpis": lambda w: bi.headline_kpis(w.fact),
}


class ReplicatedWarehouse(MaterializedWarehouse):
    """The event stream repeated ``copies`` times with shifted user and
    event ids (a generator, no join), for scaled runs."""

    def __init__(self, spark, data_dir, out_dir, copies: int, job_tag: str = ""):
        super().__init__(spark, data_dir, out_dir, job_tag)
        self.copies = copies

    @property
    def raw(self):
        events = read_table(self.spark, self.data_dir, "events")
        if self.copies > 1:
            stride = 10_000_000
            events = (events.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.copies - 1).cast("long"))))
                      .withColumn("user_id", F.col("user_id") + F.col("_copy") * stride)
                      .withColumn("event_id", F.col("event_id") + F.col("_copy") * stride * 100)
                      .drop("_copy")
                      # Real input arrives as many file splits; spread the copies
                      # the same way instead of keeping them in one task.
                      .repartition(self.spark.sparkContext.defaultParallelism))
        return fixture.raw_events(events, read_table(self.spark, self.data_dir, "part"))


def _mkdir(path: str) -> str:
    os.makedirs(path, exist_ok=True)
    return path


def stage_summary(log_dir: str, tag: str) -> dict:
    """Per step of one run (job description ``<tag><step>``): stages, tasks,
    summed and longest stage time, read from the Spark event log."""
    step_of_stage: dict[int, str] = {}
    stages: dict[int, tuple[int, int]] = {}
    files = [os.path.join(d, n) for d, _, names in os.walk(log_dir) for n in names
             if not n.startswith(".")]
    for path in files:
        with open(path, errors="replace") as f:
            for line in f:
                if '"SparkListenerJobStart"' in line:
                    ev = json.loads(line)
                    desc = (ev.get("Properties") or {}).get("spark.job.description") or ""
                    if desc.startswith(tag):
                        for sid in ev.get("Stage IDs", []):
                            step_of_stage[sid] = desc[len(tag):]
                elif '"SparkListenerStageCompleted"' in line:
                    info = json.loads(line)["Stage Info"]
                    if "Completion Time" in info and "Submission Time" in info:
                        stages[info["Stage ID"]] = (
                            info["Completion Time"] - info["Submission Time"],
                            info["Number of Tasks"])
    steps: dict[str, dict] = {}
    for sid, step in step_of_stage.items():
        if sid not in stages:
            continue                      # skipped stage (shuffle output reused)
        ms, tasks = stages[sid]
        s = steps.setdefault(step, {"stages": 0, "tasks": 0, "stage_ms": 0, "max_stage_ms": 0})
        s["stages"] += 1
        s["tasks"] += tasks
        s["stage_ms"] += ms
        s["max_stage_ms"] = max(s["max_stage_ms"], ms)
    return dict(sorted(steps.items()))


def run_once(spark, sf_dir, scratch, copies, threads, tag=""):
    wh = ReplicatedWarehouse(spark, sf_dir, scratch, copies, tag)
    times: dict[str, float] = {}
    groups: dict[str, float] = {}

    def timed(name, fn):
        spark.sparkContext.setJobDescription(f"{tag}{name}")
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return times[name]

    groups["ingest"] = timed("ingest", wh.run_ingest)
    groups["fact"] = timed("fact", lambda: wh.build("fact"))
    times["fact_events"] = times.pop("fact")
    t0 = time.perf_counter()
    for layer, sec in wh.build_many(LAYERS[1:], threads).items():
        times[LAYER_NAMES[layer]] = round(sec, 3)
    groups["marts"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    def read(item):
        name, fn = item
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"read-{name}")
        timed(name, lambda: fn(wh).collect())

    with ThreadPoolExecutor(max_workers=threads) as pool:
        list(pool.map(read, READS.items()))
    groups["reads"] = round(time.perf_counter() - t0, 3)
    fact_rows = wh.fact.count()
    return times, groups, fact_rows


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    copies = int(os.environ.get("BENCH_REPLICATE", "1"))
    threads = int(os.environ.get("BENCH_THREADS", str(cpus)))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    scratch = tempfile.mkdtemp(prefix="shoplens-bench-")
    event_log = os.environ.get("BENCH_EVENT_LOG", "1") == "1"
    conf = {
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        "spark.scheduler.mode": "FAIR",
    }
    if event_log:
        # Stage/task timings come from the event log in the scratch folder.
        conf.update({"spark.eventLog.enabled": "true",
                     "spark.eventLog.dir": _mkdir(os.path.join(scratch, "eventlog")),
                     "spark.eventLog.compress": "false",
                     "spark.eventLog.rolling.enabled": "false"})
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, cpus), extra=conf)
    spark.sparkContext.setLogLevel("ERROR")
    # One warm-up run (class loading, JIT, code generation), then the
    # measured runs; each run writes to its own folder.
    run_once(spark, sf_dir, os.path.join(scratch, "warm"), copies, threads, "warm:")
    runs = [run_once(spark, sf_dir, os.path.join(scratch, f"run{i}"), copies, threads, f"run{i}:")
            for i in range(repeat)]
    spark.stop()
    stages = (stage_summary(os.path.join(scratch, "eventlog"), f"run{repeat - 1}:")
              if event_log else {})
    times = {k: round(statistics.median(r[0][k] for r in runs), 3) for k in runs[0][0]}
    groups = {k: round(statistics.median(r[1][k] for r in runs), 3) for k in runs[0][1]}
    total = round(statistics.median(sum(r[1].values()) for r in runs), 3)
    fact_rows = runs[0][2]
    build = statistics.median(r[1]["fact"] + r[1]["marts"] for r in runs)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "pipeline_wall_clock", "value": total, "unit": "sec",
                      "queries": times, "groups": groups, "sf": sf, "replicate": copies,
                      "threads": threads, "cpus": cpus, "runs": repeat,
                      "fact_rows": fact_rows,
                      "fact_and_marts_events_per_sec": round(fact_rows / build),
                      "method": "warm run, median of runs", "event_log": stages}))


if __name__ == "__main__":
    main()
