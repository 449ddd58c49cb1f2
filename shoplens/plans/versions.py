"""Versions of a pipeline's tables, published all at once.

Every run writes its layers below a folder of its own, which no reader knows.
When all of them are whole, one row in a log makes the folder the current
version; the catalog's views are then pointed at it, each in one statement.  A
run that dies leaves the version before it in place, and a reader keeps the
files it has begun to read until that version expires.

One run at a time writes below a root.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "_versions"
LOG_SCHEMA = ("version long, path string, layers array<string>, generation long, batch_id long, "
              "sample_days int, sample_weeks int, mode string, "
              "parts map<string, array<struct<path: string, dates: array<date>>>>, "
              "columns map<string, array<string>>")
KEEP = 2                # versions whose files stay


def log(spark: SparkSession, root: str) -> DataFrame:
    """The published versions: folder and layers, what the version was built
    from (the ledger's generation and last batch, samples, mode), and the
    parts of its dated layers (``plans/refresh.py``).  Versions written before
    a column existed have NULL there."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{root}/{LOG}")
    except AnalysisException:                   # nothing published yet
        return spark.createDataFrame([], LOG_SCHEMA)


def current(spark: SparkSession, root: str) -> dict | None:
    """The newest published version, or None."""
    row = log(spark, root).orderBy(F.desc("version")).first()
    return None if row is None else row.asDict(recursive=True)


def begin(spark: SparkSession, root: str) -> tuple[int, str]:
    """(number, folder) of a version to write."""
    newest = current(spark, root)
    version = (newest["version"] if newest else 0) + 1
    return version, f"{root}/v{version:06d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, root: str, version: int, path: str, layers: list[str],
            parts: dict[str, list[tuple]] | None = None,
            columns: dict[str, list[str]] | None = None, **built_from) -> None:
    """Make a whole version the current one: a single file joins the log."""
    names = ("generation", "batch_id", "sample_days", "sample_weeks", "mode")
    row = (version, path, list(layers), *(built_from.get(n) for n in names), parts, columns)
    (spark.createDataFrame([row], LOG_SCHEMA).coalesce(1)
     .write.mode("append").parquet(f"{root}/{LOG}"))


def expire(spark: SparkSession, root: str, keep: int = KEEP) -> list[str]:
    """Remove the folders that none of the newest ``keep`` published versions
    reads, and those of runs that died before them; returns the removed names."""
    published = set()
    for row in log(spark, root).orderBy(F.desc("version")).limit(keep).collect():
        published.add(row["path"].rsplit("/", 1)[-1])
        published.update(part["path"].rsplit("/", 2)[-2]
                         for parts in (row["parts"] or {}).values() for part in parts if part["path"])
    path_type = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = path_type(root)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for entry in fs.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("v") and name[1:7].isdigit() and published and name not in published:
            fs.delete(entry.getPath(), True)
            gone.append(name)
    return sorted(gone)
