"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (the raw contract is UTC),
# adaptive execution (coalescing, skew-join splitting, runtime broadcast).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "shoplens",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    conf["spark.ui.enabled"] = "false"
    # Checkpoint files of collected DataFrames are removed, so a long-lived
    # session does not accumulate them in the shared folder.
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_core_conf(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Set the runtime-settable defaults on a session someone else built."""
    for k, v in CORE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session: keep theirs
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared
    file system).  Only a local-mode session without that setting (tests,
    this machine) gets a fresh folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="shoplens-ckpt-")
    sc.setCheckpointDir(path)
    return path


def reliable(df):
    """Cut lineage by writing ``df`` to the shared checkpoint folder.

    Used where one intermediate feeds several jobs (counts, samples and
    the final plan): later stages re-read the files instead of recomputing
    the upstream plan, and a lost executor does not lose the data.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
