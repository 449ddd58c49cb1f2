"""A fixed-size Bloom bitmap of a column of hashes.

It only thins out what is stored or shuffled; every decision is made by the
join or comparison that follows, so a false hit costs time and never a
result, and a saturated bitmap merely lets everything through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 27          # 16 MB, whatever the number of hashes
BITS_PER_HASH = 256
PROBE_SHIFT = 29            # the two probes read different bits of the hash


def build(hashes: DataFrame, column: str) -> np.ndarray:
    """Bitmap (uint64 words) of a long column, gathered by words."""
    n = hashes.agg(F.count("*").alias("n")).first()["n"]
    bits = min(MAX_BITS, max(1 << 12, 1 << (max(n, 1) * BITS_PER_HASH - 1).bit_length()))
    probe = F.explode(F.array(F.col(column), F.shiftrightunsigned(F.col(column), PROBE_SHIFT)))
    place = hashes.select(probe.alias("h")).select(
        F.col("h").bitwiseAND(F.lit(bits - 1)).alias("bit"))
    words = place.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"),
                                 F.col("bit").bitwiseAND(F.lit(63)).cast("int"))).alias("mask"))
    table = words.toArrow()
    out = np.zeros(bits >> 6, dtype="uint64")
    out[table.column("word").to_numpy()] = table.column("mask").to_numpy().view("uint64")
    return out


def contains(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the unsigned hashes may be in the bitmap."""
    top = np.uint64(len(bitmap) * 64 - 1)

    def probe(h: np.ndarray) -> np.ndarray:
        bit = h & top
        return (bitmap[(bit >> np.uint64(6)).astype("int64")] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)

    found = probe(hashes)
    at = np.flatnonzero(found)
    found[at] = probe(hashes[at] >> np.uint64(PROBE_SHIFT))
    return found


def split(df: DataFrame, key: Column, members: DataFrame, column: str
          ) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` may be among ``members``, rows whose key is not).

    Lets a join move only the rows that it may touch: the second frame needs
    no join at all.  ``key`` is a long; only it goes through Python.  ``df``
    is read once for each frame.
    """
    shared = df.sparkSession.sparkContext.broadcast(build(members, column))   # of fixed size

    @F.pandas_udf("boolean")
    def maybe(keys: pd.Series) -> pd.Series:
        return pd.Series(contains(shared.value, keys.to_numpy().view("uint64")))

    hit = maybe(key)
    return df.where(hit), df.where(~hit)
