"""Ingest as a stream: Structured Streaming over a log of arrived names.

Spark's file stream on the raw folder itself would order the files by their
modification time and skip old ones.  Here the stream reads a log that this
module writes: each run lists the raw names, appends those not yet in the log,
as one small Parquet file, and starts the stream with ``availableNow``.  The
stream's offsets are the files of that log, so the order and age of the raw
files do not matter; a name arrives once, however its file is dated.

A micro-batch is what one run found.  ``foreachBatch`` writes its files in name
order, ``files_per_batch`` a job, and enters each job in the ledger.  If a run
dies, the stream gives the same micro-batch again; names that the ledger holds
are passed over, and a file that was written but not entered is written again
into the same date folders.  Rows and ledger are those of
``incremental.run_incremental_ingest``, and both may be used in turn.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.sources.raw_csv import list_raw_files
from shoplens.streaming.incremental import ingest_log, ingest_result, ledger_state, process_files

ARRIVAL_SCHEMA = "name string, path string"
# The log's files never count as too old: one entry a run that found something.
STREAM_OPTIONS = {"maxFilesPerTrigger": 1, "maxFileAge": "36500d"}


def _folder(checkpoint_root: str, kind: str, generation: int) -> str:
    return f"{checkpoint_root}/{kind}-{generation:06d}"


def arrived(spark: SparkSession, log_dir: str) -> DataFrame:
    """The names that the log holds."""
    try:
        return spark.read.schema(ARRIVAL_SCHEMA).parquet(log_dir)
    except AnalysisException:                   # nothing has arrived yet
        return spark.createDataFrame([], ARRIVAL_SCHEMA)


def enter_arrivals(spark: SparkSession, raw_dir: str, log_dir: str, seen: DataFrame) -> bool:
    """Append the names that neither the log nor ``seen`` (a column ``name``)
    holds; whether the log has entries at all."""
    log = arrived(spark, log_dir)
    new = (list_raw_files(spark, raw_dir).join(log.select("name").union(seen.select("name")), "name", "left_anti")
           .select("name", "path"))
    rows = new.collect()                        # names of files, as the ledger's run holds them
    if rows:
        (spark.createDataFrame(rows, ARRIVAL_SCHEMA).coalesce(1).write.mode("append").parquet(log_dir))
    return bool(rows) or not log.isEmpty()


def run_stream_ingest(spark: SparkSession, raw_dir: str, out_dir: str, checkpoint_root: str,
                      sample_weeks: int | None = None, full_refresh: bool = False,
                      mode: str = "replace", files_per_batch: int = 1) -> dict:
    """Process the raw files that have arrived, as a stream that ends when all
    are done; parameters and result as ``run_incremental_ingest``."""
    if mode not in ("replace", "per_file"):
        raise ValueError(mode)
    ledger, generation, _ = ledger_state(spark, checkpoint_root, full_refresh)
    seen = ledger.where(F.col("generation") == generation).select(F.col("file").alias("name"))
    log_dir = _folder(checkpoint_root, "arrivals", generation)
    done: list[list[dict]] = []

    def take(batch: DataFrame, _: int) -> None:
        known = (ingest_log(spark, checkpoint_root).where(F.col("generation") == generation)
                 .select(F.col("file").alias("name")))
        names = spark.createDataFrame(batch.collect(), ARRIVAL_SCHEMA)
        paths = [r["path"] for r in names.join(known, "name", "left_anti").orderBy("name").collect()]
        done.extend(process_files(spark, paths, out_dir, checkpoint_root, generation, sample_weeks, mode,
                                  files_per_batch))

    if enter_arrivals(spark, raw_dir, log_dir, seen):
        query = (spark.readStream.schema(ARRIVAL_SCHEMA).options(**STREAM_OPTIONS).parquet(log_dir)
                 .writeStream.foreachBatch(take)
                 .option("checkpointLocation", _folder(checkpoint_root, "stream", generation))
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    return ingest_result(spark, checkpoint_root, generation, done)
