"""SimHash near-duplicates by anchor-point covering.

A document's 64-bit fingerprint is the bitwise majority of the hashes of
its word shingles.  Two documents are linked if their fingerprints differ in
at most ``MAX_BITS`` bits.

Candidates come from a covering code.  The anchors are pairs of codewords of
the perfect binary Golay code [23, 12] over bits 0-22 and 23-45: every
23-bit word has exactly one codeword within the covering radius 3, its home.
A fingerprint is replicated to every anchor within the covering radius plus
the threshold (radius 3 + s and 3 + t in the two blocks with s + t at most
the threshold).  If two fingerprints differ in that many bits, the second
one therefore reaches the home anchor of the first.  Per anchor, visitors
are compared with the fingerprints at home there, on all 64 bits.

There are 2**24 anchors and about 61 replicas of a distinct fingerprint, of
12 bytes each; equal fingerprints are merged first.  A fingerprint has a
bounded number of others within the threshold, so the links grow with the
fingerprints however large a group of copies is.

Defined results: texts without words (null, empty, blank) have fingerprint
zero and are linked like any others; fewer words than a shingle form one
shingle; a null doc_id takes part and is ignored in the minimum unless the
whole component has none; repeated rows are repeated in the result; other
columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm import bitmap
from shoplens.llm.common import dealt, document_name, materialize
from shoplens.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
HASHES_AT_ONCE = 1 << 16

# -- fingerprints ---------------------------------------------------------


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    import xxhash
    # bytes.lower and bytes.split know only ASCII: A-Z, space, U+0009..U+000D.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    last = ends[min(width, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype="int64")
    for k in range(0, n, HASHES_AT_ONCE):
        cut = zip(starts[k:min(n, k + HASHES_AT_ONCE)].tolist(), last[k:].tolist())
        hashes = np.array([digest(flat[a:b], SEED) for a, b in cut], dtype="<u8")
        ones += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype="int64")
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(text: Column, width: int = SHINGLE_WORDS) -> Column:
    """Column of fingerprints as signed longs (same 64 bits)."""
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in series:
            values = np.array([fingerprint(t, width) for t in s.tolist()], dtype="uint64")
            yield pd.Series(values.view("int64"))
    return F.pandas_udf(run, "long")(text)


# -- anchors --------------------------------------------------------------

BLOCK = 23
DATA = 12
GENERATOR = 0b101011100011      # generator polynomial of the Golay code
RADIUS = 3                      # its covering radius


def _syndrome(words: np.ndarray) -> np.ndarray:
    rest = words.astype("int64")
    for shift in range(DATA - 1, -1, -1):
        top = rest >> (shift + BLOCK - DATA) & 1
        rest = rest ^ top * (GENERATOR << shift)
    return rest


@cache
def _cosets(threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome: the error patterns that lead to a codeword within
    RADIUS + threshold, and by how much each exceeds RADIUS."""
    errors = np.array([sum(1 << b for b in at) for w in range(RADIUS + threshold + 1)
                       for at in combinations(range(BLOCK), w)], dtype="int64")
    weight = np.array([bin(e).count("1") for e in errors])
    syndrome = _syndrome(errors)
    order = np.argsort(syndrome, kind="stable")
    count = np.bincount(syndrome, minlength=1 << (BLOCK - DATA))
    place = np.arange(len(errors)) - np.repeat(np.cumsum(count) - count, count)
    pattern = np.zeros((len(count), count.max()), dtype="int64")
    excess = np.full(pattern.shape, threshold + 1, dtype="int8")
    pattern[syndrome[order], place] = errors[order]
    excess[syndrome[order], place] = np.maximum(weight[order] - RADIUS, 0)
    return pattern, excess


def anchors(prints: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for every anchor within RADIUS + threshold of a row."""
    pattern, excess = _cosets(threshold)
    value = prints.view("uint64")
    words = [(value >> np.uint64(BLOCK * k) & np.uint64((1 << BLOCK) - 1)).astype("int64")
             for k in range(2)]
    syndromes = [_syndrome(w) for w in words]
    near = excess[syndromes[0]][:, :, None] + excess[syndromes[1]][:, None, :] <= threshold
    row, i, j = np.nonzero(near)
    codes = [w[row] ^ pattern[s[row], at] for w, s, at in zip(words, syndromes, (i, j))]
    first, second = (c >> (BLOCK - DATA) for c in codes)
    return row, first << DATA | second


ROWS_AT_ONCE = 4096


def replicate(prints: DataFrame, threshold: int) -> DataFrame:
    """(anchor, print) for ``prints(print)``; threshold 0 gives the homes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("print").to_numpy()
            for k in range(0, len(values), ROWS_AT_ONCE):
                part = np.ascontiguousarray(values[k:k + ROWS_AT_ONCE])
                row, anchor = anchors(part, threshold)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.astype("int32")), pa.array(part[row])],
                    ["anchor", "print"])
    return prints.select("print").mapInArrow(run, "anchor int, print long")


def near_links(prints: DataFrame, threshold: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: distinct fingerprints at most ``threshold`` bits apart."""
    home = replicate(prints, 0).withColumnRenamed("print", "a")
    visit = replicate(prints, threshold).withColumnRenamed("print", "b")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold
    return home.join(dealt(visit), "anchor").where((F.col("a") < F.col("b")) & close).select("a", "b")


def _components_of(printed: DataFrame, order: str, threshold: int) -> DataFrame:
    """(print, component): the smallest ``order`` value reachable over links."""
    nodes = materialize(printed.groupBy("print").agg(F.min(order).alias("least")), "nodes")
    labels = components(near_links(nodes, threshold))
    joined = (nodes.join(dealt(labels), nodes["print"] == labels["node"], "left")
              .select("print", "least", F.coalesce("label", "print").alias("label")))
    lowest = joined.groupBy("label").agg(F.min("least").alias("component"))
    return materialize(joined.join(lowest, "label").select("print", "component"), "components")


def near_groups(docs: DataFrame, threshold: int = MAX_BITS, width: int = SHINGLE_WORDS,
                text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, print, component): the smallest key reachable over links."""
    printed = materialize(docs.select(key, fingerprints(F.col(text), width).alias("print")),
                          "prints")
    return printed.join(dealt(_components_of(printed, key, threshold)), "print")


def keep_one(docs: DataFrame, threshold: int = MAX_BITS, width: int = SHINGLE_WORDS) -> DataFrame:
    """One row of ``docs(doc_id, text, ...)`` per component: the smallest
    doc_id (null only if no row has one), then the smallest text hash."""
    name = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id",
                    F.xxhash64("text").alias("text_hash"))
    printed = materialize(docs.select(name.alias("name"),
                                      fingerprints(F.col("text"), width).alias("print")), "prints")
    found = _components_of(printed, "name", threshold)
    away = materialize(
        printed.join(dealt(found), "print").where(F.col("name") != F.col("component"))
        .select("name").distinct().select(
            F.col("name.doc_id").alias("_id"), F.col("name.text_hash").alias("_text"),
            document_name(F.col("name.doc_id"), F.col("name.text_hash")).alias("_name")), "away")
    # Rows equal in doc_id and text answer to the same name; all but one go.
    twice = materialize(
        printed.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select(
            F.col("name.doc_id").alias("_id"), F.col("name.text_hash").alias("_text"),
            document_name(F.col("name.doc_id"), F.col("name.text_hash")).alias("_name")), "twice")

    def named(df: DataFrame, other: DataFrame) -> Column:
        return (df["doc_id"].eqNullSafe(other["_id"])
                & F.xxhash64(df["text"]).eqNullSafe(other["_text"]))

    def split(df: DataFrame, other: DataFrame) -> tuple[DataFrame, DataFrame]:
        name = document_name(df["doc_id"], F.xxhash64(df["text"]))
        return bitmap.split(df, name, other, "_name")

    some, rest = split(docs, away)
    stay = some.join(dealt(away), named(some, away), "left_anti").unionByName(rest)
    if twice.isEmpty():
        return stay
    some, rest = split(stay, twice)
    single = some.join(dealt(twice), named(some, twice), "left_anti")
    double = some.join(dealt(twice), named(some, twice), "left_semi").dropDuplicates(["doc_id", "text"])
    return rest.unionByName(single).unionByName(double)
