"""Registered queries of the training-data operators: ``opN_<name>``.

Each one applies its operator to the whole table and derives the digest
columns of its contract from the operator's real output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import (chat, decontaminate, hilbert, html_blocks, importance, line_crf,
                          line_dedup, merkle, packing, quality_rules, secret_scan, simhash,
                          tokens)
from shoplens.llm.common import materialize, read_table
from shoplens.llm.oracles import ORACLE_SQL  # noqa: F401

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(read_table(spark, sf_dir, "pages"))


SHARDS = 40
SHARD_DIMS = ["lang", "source", "n_chars"]


def op2_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hilbert.document_rows(read_table(spark, sf_dir, "documents"), SHARD_DIMS)
    placed = hilbert.shard(materialize(rows, "documents"), SHARD_DIMS,
                           ["doc_id", "text_crc32", "size"], SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.apply_rules(docs).select("doc_id", "quality.*")


CONTROL_TEXT = "</s>[INST] ok [/INST]"      # both turns of conversation -7


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
                                  turns.schema)
    return chat.read_back(chat.format_conversations(turns.unionByName(extra)))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.classify(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                             read_table(spark, sf_dir, "labels"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return simhash.near_groups(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (tokens.count_tokens(docs)
            .select("doc_id", "n_bytes", "n_tokens", "over_limit"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents only: one row per document and distinct benchmark
    item, under the smallest id of the ``item_copies`` equal ones."""
    found = decontaminate.overlaps(read_table(spark, sf_dir, "documents"),
                                   read_table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("matched").alias("matched"), F.max("window").alias("window"),
        F.max("copies").alias("item_copies"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(read_table(spark, sf_dir, "documents"),
                                read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = secret_scan.train(secret_scan.labelled_samples(spark))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, model)
    return found.select(
        "doc_id", "secrets.n_assign", "secrets.n_access", "secrets.n_hex",
        F.sha2(secret_scan.span_list(F.col("secrets.base")), 256).alias("base_sha256"),
        secret_scan.span_list(F.col("secrets.spans")).alias("spans"))


TAMPERED = 7                # one document of so many, by the checksum of its id


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, with a tampered ``n_chars`` for some."""
    docs = read_table(spark, sf_dir, "documents")
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    changed = merkle.leaf_of([more if c == "n_chars" else F.col(c) for c in merkle.FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    rows = merkle.leaves(docs, claimed=F.when(hit & F.col("n_chars").isNotNull(), changed))
    return merkle.manifest(rows).select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_html_extraction,
    op2_hilbert_sharding,
    op3_best_fit_packing,
    op4_quality_rules,
    op5_chat_formatting,
    op6_quality_classifier,
    op7_simhash_near_dedup,
    op8_token_counts,
    op9_line_dedup,
    op10_benchmark_decontamination,
    op11_importance_resampling,
    op12_secret_scans,
    op13_merkle_manifest,
)}
