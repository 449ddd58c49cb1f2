"""Incremental raw-file ingest against a ledger of processed file names.

A run lists the ``*.csv`` names under the raw folder (a metadata-only read,
so any file system Spark reads will do), takes away the names that the
ledger table holds for the current generation, and processes the rest in
name order, ``files_per_batch`` at a time.  A name counts as new however old
its file is.  A full refresh starts a new generation, in which no name is
known yet.

* Each batch is cleaned and written to the date-partitioned sink, and only
  then entered in the ledger, one row per file; a run that dies in between
  redoes that batch, which overwrites the same date folders.
* In ``replace`` mode a date belongs to the last file (by name) that has a
  kept row of it, across runs and inside a batch alike, so the batch size
  never decides which rows survive.  ``per_file`` mode also partitions by
  source file, which is lossless.
* The first-N-weeks sample uses each file's own first date.
* Statistics per file are observed in the same pass as the write.

The streaming file source is not used on the raw folder: it orders by
modification time and forgets or skips files by age.  ``arrivals.py`` streams
a log of the names instead.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.plans.ingest import (clean_events, invalid_price_flag, parsed_time,
                                   write_partitioned)
from shoplens.schema import VALID_EVENT_TYPES
from shoplens.sources.raw_csv import list_raw_files, read_raw_csv

LEDGER = "ledger"
LEDGER_SCHEMA = ("generation long, batch_id long, file string, total_rows long, "
                 "unparsed_rows long, invalid_event_types long, invalid_prices long, "
                 "min_time timestamp_ntz, max_time timestamp_ntz, processed_rows long, "
                 "partitions long, dates array<date>")
STATISTICS = [c.split()[0] for c in LEDGER_SCHEMA.split(", ")][3:]


def ingest_log(spark: SparkSession, checkpoint_root: str) -> DataFrame:
    """The ledger: one row per generation and file (the latest, if a batch
    was entered twice)."""
    try:
        rows = spark.read.schema(LEDGER_SCHEMA).parquet(f"{checkpoint_root}/{LEDGER}")
    except AnalysisException:                   # no run yet
        return spark.createDataFrame([], LEDGER_SCHEMA)
    latest = Window.partitionBy("generation", "file").orderBy(F.desc("batch_id"))
    return rows.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")


def _new_files(spark: SparkSession, raw_dir: str, ledger: DataFrame, generation: int) -> list[str]:
    """Paths of the files whose names the generation has not seen, by name."""
    listed = list_raw_files(spark, raw_dir)
    seen = ledger.where(F.col("generation") == generation).select(F.col("file").alias("name"))
    return [r["path"] for r in listed.join(seen, "name", "left_anti").orderBy("name").collect()]


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _sample_per_file(clean: DataFrame, weeks: int) -> DataFrame:
    """First-N-weeks sample with each source file's own first date."""
    firsts = clean.groupBy("_src").agg(F.min("event_date").alias("_first"))
    # one row per file of the batch: bounded by files_per_batch
    return (clean.join(F.broadcast(firsts), "_src")
            .where(F.col("event_date") <= F.date_add("_first", 7 * weeks))
            .drop("_first"))


def _last_file_of_each_date(clean: DataFrame) -> DataFrame:
    """Rows of the last file (by name) among those that hold a date."""
    last = clean.groupBy("event_date").agg(F.max("_src").alias("_src"))
    return clean.join(last, ["event_date", "_src"], "left_semi")


def _per_file(files: list[str], metrics: dict) -> list[Column]:
    """Every metric once per file: name -> f(rows of this file)."""
    return [metric(F.col("_src") == name).alias(f"{key}_{i}")
            for i, name in enumerate(files) for key, metric in metrics.items()]


def _found(observation: Observation, df: DataFrame, metrics: list[Column]) -> dict:
    """The observed metrics; counted anew if nothing was written, since
    adaptive execution then drops the observed part of the plan."""
    try:
        return observation.get
    except Py4JJavaError:
        return df.agg(*metrics).first().asDict()


def _raw_batch(spark: SparkSession, paths: list[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        read_raw_csv(spark, p).withColumn("_src", F.lit(_name(p))) for p in paths])


def _run_batch(spark: SparkSession, paths: list[str], out_dir: str, sample_weeks: int | None,
               mode: str) -> list[dict]:
    """Clean and write some files; the statistics of each."""
    files = [_name(p) for p in paths]
    raw = _raw_batch(spark, paths)
    ts = parsed_time(raw)
    bad_type = F.col("event_type").isin(*VALID_EVENT_TYPES) == F.lit(False)
    before, after = Observation(), Observation()
    raw_metrics = _per_file(files, {
        "total_rows": lambda own: F.count_if(own),
        "unparsed_rows": lambda own: F.count_if(own & F.col("unparsed")),
        "invalid_event_types": lambda own: F.count_if(own & bad_type),
        "invalid_prices": lambda own: F.count_if(own & invalid_price_flag()),
        "min_time": lambda own: F.min(F.when(own, ts)),
        "max_time": lambda own: F.max(F.when(own, ts))})
    clean = clean_events(raw.observe(before, *raw_metrics), keep=("_src",))
    if sample_weeks:
        clean = _sample_per_file(clean, sample_weeks)
    clean_metrics = _per_file(files, {
        "processed_rows": lambda own: F.count_if(own),
        "dates": lambda own: F.array_join(F.array_sort(F.collect_set(
            F.when(own, F.col("event_date").cast("string")))), " ")})
    kept, clean = clean, clean.observe(after, *clean_metrics)
    folders: tuple[str, ...] = ("event_date",)
    if mode == "per_file":
        clean = clean.withColumnRenamed("_src", "source_file")
        folders = ("event_date", "source_file")
    elif len(files) > 1:
        clean = _last_file_of_each_date(clean).drop("_src")
    else:
        clean = clean.drop("_src")
    write_partitioned(clean, out_dir, partition_cols=folders)
    found = _found(before, raw, raw_metrics) | _found(after, kept, clean_metrics)
    done = []
    for i, name in enumerate(files):
        dates = [dt.date.fromisoformat(d) for d in found[f"dates_{i}"].split()]
        counts = {k: found[f"{k}_{i}"] for k in STATISTICS if k not in ("partitions", "dates")}
        done.append({"file": name, **counts, "partitions": len(dates), "dates": dates})
    return done


def dates_since(spark: SparkSession, checkpoint_root: str, generation: int, batch_id: int) -> list[dt.date] | None:
    """The dates that batches of the generation after ``batch_id`` wrote, or
    None where the ledger does not know (entries of an older layout).  Read
    from all entries: a batch entered twice wrote its dates twice."""
    later = (spark.read.schema(LEDGER_SCHEMA).parquet(f"{checkpoint_root}/{LEDGER}")
             .where((F.col("generation") == generation) & (F.col("batch_id") > batch_id)))
    found = later.agg(F.count_if(F.col("dates").isNull()),
                      F.array_distinct(F.flatten(F.collect_set("dates")))).first()
    return None if found[0] else sorted(found[1])


def run_incremental_ingest(spark: SparkSession, raw_dir: str, out_dir: str,
                           checkpoint_root: str, sample_weeks: int | None = None,
                           full_refresh: bool = False, mode: str = "replace",
                           files_per_batch: int = 1) -> dict:
    """Process the raw CSV files not yet seen.

    Returns ``status`` (``success`` or ``no_new_files``), ``files`` (the
    statistics of each file of this run), ``batches``, ``total_rows`` (raw
    rows of the whole generation so far), ``generation`` and ``batch_id`` (the
    last one entered).
    """
    if mode not in ("replace", "per_file"):
        raise ValueError(mode)
    ledger, generation, batch_id = ledger_state(spark, checkpoint_root, full_refresh)
    paths = _new_files(spark, raw_dir, ledger, generation)
    done = process_files(spark, paths, out_dir, checkpoint_root, generation, sample_weeks, mode,
                         files_per_batch)
    return ingest_result(spark, checkpoint_root, generation, done)


def ledger_state(spark: SparkSession, checkpoint_root: str, full_refresh: bool) -> tuple[DataFrame, int, int]:
    """(ledger, generation to work in, last batch entered)."""
    ledger = ingest_log(spark, checkpoint_root)
    newest = ledger.agg(F.max("generation"), F.max("batch_id")).first()
    return ledger, (newest[0] or 0) + (1 if full_refresh or not newest[0] else 0), newest[1] or 0


def process_files(spark: SparkSession, paths: list[str], out_dir: str, checkpoint_root: str, generation: int,
                  sample_weeks: int | None, mode: str, files_per_batch: int) -> list[list[dict]]:
    """Write the files in batches, entering each in the ledger; the
    statistics per batch and file."""
    batch_id = ledger_state(spark, checkpoint_root, False)[2]
    done: list[list[dict]] = []
    for k in range(0, len(paths), files_per_batch):
        batch_id += 1
        stats = _run_batch(spark, paths[k:k + files_per_batch], out_dir, sample_weeks, mode)
        rows = [tuple([generation, batch_id, s["file"], *(s[c] for c in STATISTICS)]) for s in stats]
        (spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1)
         .write.mode("append").parquet(f"{checkpoint_root}/{LEDGER}"))
        done.append(stats)
    return done


def ingest_result(spark: SparkSession, checkpoint_root: str, generation: int, done: list[list[dict]]) -> dict:
    """What a run returns, see ``run_incremental_ingest``."""
    ledger, _, batch_id = ledger_state(spark, checkpoint_root, False)
    total = (ledger.where(F.col("generation") == generation)
             .agg(F.coalesce(F.sum("total_rows"), F.lit(0))).first()[0])
    return {"status": "success" if done else "no_new_files", "files": [s for b in done for s in b],
            "batches": len(done), "total_rows": total, "generation": generation, "batch_id": batch_id}
