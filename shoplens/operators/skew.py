"""Joining rows with an aggregate of their own key, when a key may be hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_key_aggregate(rows: DataFrame, key: str, value: Column, out: str,
                       spread: Sequence[str]) -> DataFrame:
    """``rows`` plus ``out``: the aggregate ``value`` over all rows of the same
    ``key`` (NULL for a NULL key).

    The aggregate per key also counts the key's rows.  Keys with more than
    half an average shuffle partition are heavy; there are at most twice as
    many of them as partitions, whatever the data, and their values travel as
    one small map.  Their rows, and those without a key, are dealt out by a
    hash of ``spread`` instead of the key (columns in which the rows of a key
    differ; no others are read for it), so they fill all partitions evenly;
    all other rows meet their key's value in a shuffle join.  All of
    it is one lazy plan: the map and the join read the same exchange.
    """
    spark = rows.sparkSession
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    per_key = rows.groupBy(key).agg(value.alias("_value"), F.count(F.lit(1)).alias("_rows"))
    # Every reader of the aggregate uses both columns: one exchange serves all.
    total = per_key.agg(F.struct(F.sum("_rows").alias("n"), F.max("_value").alias("last"))).scalar()
    light = F.col("_rows") * parts <= total.getField("n")
    heavy = (per_key.where(F.col(key).isNotNull() & ~light)
             .agg(F.map_from_entries(F.collect_list(F.struct(key, "_value")))).scalar())
    kind = rows.schema[key].dataType
    known = F.element_at(heavy, F.col(key))
    dealt = (rows.withColumn("_known", known)
             .withColumn("_deal", F.when(F.col(key).isNull() | F.col("_known").isNotNull(),
                                         F.xxhash64(*spread).cast(kind)).otherwise(F.col(key))))
    values = per_key.where(light).select(F.col(key).alias("_key"), "_value")
    # A row of a heavy key is dealt by another number and finds no partner.
    joined = dealt.join(values, (F.col("_deal") == F.col("_key")) & (F.col(key) == F.col("_key")), "left")
    return joined.select(*rows.columns, F.coalesce("_known", "_value").alias(out))
