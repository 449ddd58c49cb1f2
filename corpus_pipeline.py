"""The training-corpus pipeline over ``documents``.

Five stages, each one an operator of ``shoplens.llm``; every stage reads
what the one before it has written and hands on all the rows it keeps, with
the columns of ``documents``.  The last one returns the packing plan.

Defined results: null and empty texts have no words and go with the first
stage; repeated rows share the fate of the first stage, lose the same lines
and leave one of them in the third; ties are broken by the smallest doc_id,
a null one first; texts of any length are taken whole; columns beyond those
of ``documents`` are kept, whatever their names, and ``n_chars`` follows the
text where it exists; an empty table gives an empty plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from shoplens.llm.common import unused
from shoplens.session import ensure_checkpoint_dir
from shoplens.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of lines that occur earlier in the corpus."""
    name = unused(docs, "removed_chunks")
    out = line_dedup.dedup_lines(docs, name).drop(name)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicate fingerprints."""
    return simhash.keep_one(docs)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with a benchmark item."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents with their sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", repeated_lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_overlap),
    ("best_fit_packing", packed),
]

# No stage between the rules and the packing is expressible in SQL; the
# tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
