"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.session import ensure_checkpoint_dir
from shoplens.sources.tables import read_table

__all__ = ["read_table", "materialize", "dealt", "md5_rank", "document_name", "slices", "unused"]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    The lineage is cut at a table that every executor can read, so a lost
    executor costs a re-read and never a recomputation, and the file layout
    gives the optimizer real sizes.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.mode("error").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that deals out both sides by the key.

    Spark takes a stored table for as large as its compressed file, an array
    for one element and a Python step's rows for as many as it was given, so a
    table of many times the driver's memory can pass for one to broadcast.
    """
    return df.hint("merge")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut small, so that few texts are Python objects at once."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def document_name(doc_id: Column, text_hash: Column) -> Column:
    """One long for (doc_id, text hash), the identity of a document."""
    return F.xxhash64(doc_id.cast("long"), text_hash)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def md5_rank(*cols: Column) -> Column:
    """A well-mixed rank in [0, 2**32) from the given columns (nulls: empty)."""
    text = F.concat_ws("/", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
