"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a large fact to a dimension projected to the columns it needs.

    No hint: the engine broadcasts the dimension only if its measured bytes
    are under ``spark.sql.autoBroadcastJoinThreshold`` (from file statistics
    when planning, from shuffle sizes at run time), and otherwise sorts and
    merges, splitting a hot key of the fact side.
    """
    return fact.join(dim, on, how)


def scalar(one_value: DataFrame):
    """An uncorrelated scalar subquery as a Column: ``one_value`` is a
    one-row, one-column frame (a global aggregate).  Spark runs it once,
    inlines the value, and reuses it where the same subquery repeats."""
    return one_value.scalar()
