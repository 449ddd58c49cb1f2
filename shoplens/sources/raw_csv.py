"""Raw CSV event files: discovery and a reader bound to the header names."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.schema import RAW_CSV_SCHEMA


def list_raw_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """(name, path) of the ``*.csv`` files in ``raw_dir``; a missing folder
    is empty, and files of no bytes are not listed.  Only file metadata is
    read."""
    try:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
                 .load(raw_dir).select("path"))
    except AnalysisException:
        files = spark.createDataFrame([], "path string")
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "path")


def _is_set(name: str) -> Column:
    return F.trim(F.col(f"`{name}`")) != ""


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read one raw CSV file (or a folder of files with one header).

    Columns are found by their header names, in any order; others are
    ignored and a missing one is an error.  ``event_time`` stays text:
    ``clean_events`` parses it and drops rows without a time, as in the
    contract.  ``unparsed`` marks rows with a text that its type cannot
    hold, so that such rows are counted instead of lost.
    """
    text = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    by_name = {c.strip().lower(): c for c in text.columns}
    missing = [f.name for f in RAW_CSV_SCHEMA if f.name not in by_name]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    from shoplens.plans.ingest import time_of_text
    typed, lost = [], []
    for f in RAW_CSV_SCHEMA:
        raw = by_name[f.name]
        value = F.col(f"`{raw}`")
        if f.dataType.typeName() != "string":
            value = F.trim(value).try_cast(f.dataType)
            lost.append(_is_set(raw) & value.isNull())
        if f.name == "event_time":
            lost.append(_is_set(raw) & time_of_text(value).isNull())
        typed.append(value.alias(f.name))
    unparsed = F.coalesce(reduce(Column.__or__, lost), F.lit(False))
    return text.select(*typed, unparsed.alias("unparsed"))
