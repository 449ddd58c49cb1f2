"""Hilbert-curve sharding: multidimensional order, cut into equal runs.

Several metadata dimensions are quantised to a small grid; the cells are
ordered along a Hilbert curve, rows inside a cell by a hash of their key;
the order is cut into runs of equal row counts.  Neighbouring cells are
neighbours in the metadata, so a shard covers a small box of values in
every dimension and a reader prunes shards by each of them.

A dimension of at most ``2 ** BITS`` distinct values has a bin for each,
spread over the grid; one of more has bins with equally many distinct values,
between edges that are exact quantiles of all of them.

All of it is DataFrame code.  Only counts are ordered: at most one row per
grid cell is sorted globally, and distinct values and rows are numbered inside
ranges whose size does not follow the largest cell (``numbered``), so neither
a value nor a key that a third of all rows share meets in one task.

Defined results: null dimensions fall into the lowest bin; a null text has
no bytes and CRC 0; equal texts with equal metadata share a cell; rows that
are equal in all columns used are numbered in any order; an empty table
gives no rows; other columns pass through, except ``shard`` and ``slot``, and
names that begin with ``__`` are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import materialize, md5_rank
from shoplens.llm.ordering import numbered

BITS = 4                    # grid bins per dimension: 2**BITS


def bin_edges(df: DataFrame, name: str, bits: int = BITS) -> list[tuple[int, object]]:
    """(bin, its smallest value) of a dimension's bins above 0, ascending.  A
    few values are spread over the whole grid, so that the curve separates
    them before it turns to finer differences."""
    values = materialize(df.select(F.col(name).alias("v")).where("v IS NOT NULL").distinct(),
                         "values")
    number = _div(F.col("position") * (1 << bits), F.col("size"))
    edges = (numbered(values, ["v"]).groupBy(number.alias("b")).agg(F.min("v").alias("v"))
             .where("b > 0").orderBy("b"))
    return [(r["b"], r["v"]) for r in edges.collect()]


def quantise(df: DataFrame, dims: list[str], bits: int = BITS) -> list[Column]:
    """Bin numbers 0 .. 2**bits - 1 of each dimension: the last edge reached."""
    bins = []
    for name in dims:
        number, below = F.lit(0), 0
        for b, edge in bin_edges(df, name, bits):
            reached = F.coalesce(F.col(name) >= F.lit(edge), F.lit(False))
            number, below = number + reached.cast("int") * (b - below), b
        bins.append(number)
    return bins


def hilbert_index(point: Column, dims: int, bits: int = BITS) -> Column:
    """Position of a grid point (array of bin numbers) on the Hilbert curve.

    The published bit-transposition method: undo the curve's rotations from
    the highest bit down, Gray-encode, then interleave the bits.
    """
    def step(x: Column, s: Column) -> Column:
        i, q = F.get(s, F.lit(0)), F.get(s, F.lit(1))
        head, own = x.getItem(0), F.get(x, i)
        swap = head.bitwiseXOR(own).bitwiseAND(q - 1)
        return F.transform(x, lambda v, k: F.when(
            own.bitwiseAND(q) != 0,
            F.when(k == 0, v.bitwiseXOR(q - 1)).otherwise(v)).otherwise(
            F.when((k == 0) | (k == i), v.bitwiseXOR(swap)).otherwise(v)))

    steps = F.array(*[F.array(F.lit(i), F.lit(1 << b))
                      for b in range(bits - 1, 0, -1) for i in range(dims)])
    turned = F.aggregate(steps, point, step)
    # Gray code: each axis takes the running exclusive-or of those before it.
    def running(acc: Column, v: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        return F.concat(acc, F.array(F.coalesce(last, F.lit(0)).bitwiseXOR(v)))
    gray = F.aggregate(turned, F.array().cast("array<int>"), running)

    def finish(x: Column) -> Column:
        last = F.get(x, F.lit(dims - 1))
        flip = F.lit(0)
        for b in range(bits - 1, 0, -1):
            flip = flip.bitwiseXOR(F.when(last.bitwiseAND(F.lit(1 << b)) != 0,
                                          F.lit((1 << b) - 1)).otherwise(0))
        index = F.lit(0).cast("long")
        for b in range(bits - 1, -1, -1):
            for i in range(dims):
                bit = F.shiftright(x.getItem(i).bitwiseXOR(flip), b).bitwiseAND(F.lit(1))
                index = index * 2 + bit
        return index

    return F.transform(F.array(gray), finish).getItem(0)


def hilbert_order(df: DataFrame, dims: list[str], key: list[str],
                  bits: int = BITS) -> DataFrame:
    """``df`` plus ``__position``: the 0-based place along the curve.

    ``df`` should be a stored table; rows of one cell are ordered by the MD5
    of the first ``key`` column, then by the key columns.
    """
    number = F.lit(0)
    for one in quantise(df, dims, bits):
        number = number * (1 << bits) + one
    celled = materialize(df.withColumn("__cell", number.cast("int"))
                         .withColumn("__rank", md5_rank(F.col(key[0]))), "cells")
    point = F.array(*[F.shiftright("__cell", bits * i).bitwiseAND(F.lit((1 << bits) - 1))
                      for i in reversed(range(len(dims)))])
    sizes = celled.groupBy("__cell").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("__index").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__index", hilbert_index(point, len(dims), bits)).select(
        F.col("__cell").alias("__at"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("__cell_start"))
    placed = numbered(celled, ["__rank", *key], "__cell", "__within", "__cell_rows")
    return (placed.join(F.broadcast(starts), F.col("__cell") == F.col("__at"))
            .withColumn("__position", F.col("__cell_start") + F.col("__within"))
            .drop("__cell", "__rank", "__at", "__cell_start", "__cell_rows", "__within"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b.cast("long"))


def shard(df: DataFrame, dims: list[str], key: list[str], shards: int,
          bits: int = BITS) -> DataFrame:
    """``df`` plus shard (0 .. shards - 1, counts at most one apart) and slot
    (0-based, gapless in each shard), in Hilbert order of ``dims``."""
    ordered = hilbert_order(df, dims, key, bits)
    total = df.agg(F.count("*")).scalar()
    shard_no = _div(F.col("__position") * shards, total)
    first = _div(shard_no * total + (shards - 1), F.lit(shards))
    return (ordered.withColumn("shard", shard_no.cast("int"))
            .withColumn("slot", (F.col("__position") - first).cast("long"))
            .drop("__position"))


def document_rows(docs: DataFrame, dims: list[str]) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 16), text_crc32 and the dimensions."""
    return docs.select(
        "doc_id", *dims,
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard, rows in slot order."""
    (sharded.repartitionByRange("shard").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
