"""Gapless positions in a global order, without a global sort task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import materialize, shuffle_partitions

_PART_SHIFT = 33            # monotonically_increasing_id: partition above, row below


def numbered(df: DataFrame, order: Sequence[str], group: str | None = None,
             position: str = "position", size: str = "size") -> DataFrame:
    """``df`` plus the 0-based gapless ``position`` of each row in its group
    by ascending ``order`` (nulls first) and the ``size`` of the group.

    The rows are dealt into ranges of (group, order), each sorted by its own
    task; a row's place is its place in the range plus the rows of its group
    in earlier ranges, of which there is one count per range and group.  A
    random last key lets rows that are equal in all columns spread over
    several ranges: which of them comes first is open, as they are equal.
    The ranges are written before they are counted, so a task that runs again
    cannot deal them differently.

    ``df`` is read twice (once to find the ranges): pass a stored table.
    Helper columns start with ``__order_``.
    """
    keys = [*([group] if group else []), *order]
    dealt = (df.withColumn("__order_salt", F.rand(7))
             .repartitionByRange(shuffle_partitions(df.sparkSession), *keys, "__order_salt")
             .sortWithinPartitions(*keys, "__order_salt").drop("__order_salt")
             .withColumn("__order_at", F.monotonically_increasing_id()))
    rows = materialize(
        dealt.withColumn("__order_part", F.shiftright("__order_at", _PART_SHIFT))
        .withColumn("__order_group", F.col(group) if group else F.lit(0)), "ordered")
    counts = rows.groupBy("__order_group", "__order_part").agg(
        F.min("__order_at").alias("__order_low"), F.count("*").alias("__order_rows"))
    own = Window.partitionBy("__order_group")
    before = own.orderBy("__order_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("__order_group").alias("__order_g"), F.col("__order_part").alias("__order_p"),
        (F.coalesce(F.sum("__order_rows").over(before), F.lit(0)) - F.col("__order_low"))
        .alias("__order_shift"),
        F.sum("__order_rows").over(own).alias("__order_size"))
    return (rows.join(starts, F.col("__order_group").eqNullSafe(F.col("__order_g"))
                      & (F.col("__order_part") == F.col("__order_p")))
            .select(*df.columns, (F.col("__order_at") + F.col("__order_shift")).alias(position),
                    F.col("__order_size").alias(size)))
