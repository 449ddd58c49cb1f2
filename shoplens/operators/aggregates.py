"""Aggregation building blocks.

``COUNT(DISTINCT CASE WHEN flag THEN user_id END)`` for several flags at
once makes Catalyst expand every input row once per distinct expression.
The two-level form used here aggregates per (keys, user) first -- a
map-side partial aggregate, so a hot user shrinks to one row per task before
the shuffle -- and then counts users per key with plain sums.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions import ratio_pct

STAGE_TYPES = ("view", "cart", "purchase")


def user_stage_flags(events: DataFrame, keys: Sequence[str], extra: dict[str, Column] | None = None,
                     user: str = "user_id") -> DataFrame:
    """Level 1: one row per (keys, user) with 0/1 flags ``has_<type>`` and
    any extra aggregates."""
    aggs = [F.max(F.when(F.col("event_type") == t, 1).otherwise(0)).alias(f"has_{t}")
            for t in STAGE_TYPES]
    aggs += [expr.alias(name) for name, expr in (extra or {}).items()]
    return events.groupBy(*keys, user).agg(*aggs)


def users_with(flag: str, user: str = "user_id") -> Column:
    """Level 2: distinct users whose flag is set (NULL users never count)."""
    return F.count_if((F.col(flag) == 1) & F.col(user).isNotNull())


def tagged_ids(events: DataFrame, keys: Sequence[str], ids: dict[str, str],
               measures: dict[str, dict[str, tuple[Column, Callable[[Column], Column]]]]) -> DataFrame:
    """One row per (keys, kind, id): several distinct counts in one shuffle.

    ``ids`` maps a kind to its column; every event becomes one row per kind,
    tagged with it.  ``measures`` has the aggregates of a kind: name ->
    (input column, aggregate); they are NULL for rows of other kinds.  Counting
    a kind's rows per key gives COUNT(DISTINCT its column).  The first level is
    a partial aggregate, so an id that many events share is one row a task
    before the shuffle.
    """
    inputs = {name: c for kind in measures.values() for name, (c, _) in kind.items()}
    tags = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(column).cast("long").alias("id"))
                     for kind, column in ids.items()])
    tagged = (events.select(*keys, *[c.alias(f"_{n}") for n, c in inputs.items()],
                            F.explode(tags).alias("_tag"))
              .select(*keys, F.col("_tag.kind").alias("kind"), F.col("_tag.id").alias("id"),
                      *[F.when(F.col("_tag.kind") == kind, F.col(f"_{name}")).alias(name)
                        for kind, own in measures.items() for name in own]))
    return tagged.groupBy(*keys, "kind", "id").agg(
        *[agg(F.col(name)).alias(name) for own in measures.values() for name, (_, agg) in own.items()])


def share_of_total(df: DataFrame, column: str, out: str = "pct") -> DataFrame:
    """``column * 100 / SUM(column) OVER ()`` rounded to 2 places; the total
    is a scalar subquery (partial sums per task), so no row moves to one
    partition."""
    total = df.agg(F.sum(column)).scalar()
    return df.withColumn(out, ratio_pct(F.col(column), total))
