"""Ordered-window helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous_row(df: DataFrame, partition: Sequence[str], order: Sequence[str],
                 cols: dict[str, str]) -> DataFrame:
    """LAG by one *row* (not one period): ``{out: source}`` columns holding
    the previous present row's value within each partition.  Meant for
    already-aggregated inputs (one row per period and key)."""
    spec = (Window.partitionBy(*partition) if partition else Window.partitionBy()).orderBy(*order)
    for out, src in cols.items():
        df = df.withColumn(out, F.lag(src).over(spec))
    return df


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """ORDER BY ... LIMIT k.  Planned as TakeOrderedAndProject: each task
    keeps its own k best rows, so only k rows per task move.  Callers put a
    unique tie-break last in ``order`` so the result is deterministic."""
    return df.orderBy(*order).limit(k)
