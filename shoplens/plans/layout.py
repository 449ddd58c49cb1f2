"""Tables laid out by user, so that per-user work needs no shuffle.

``by_user`` stores rows in buckets of ``user_id``, sorted by it.  A group-by
or a join on the user then runs inside each bucket: first dates, the event
fact and the users' RFM rows read their input without an exchange.

A bucket cannot be split, so users with more rows than an average bucket, and
rows without a user, are kept apart in a plain table (``hot``).  There are
fewer such users than buckets, whatever the data; their rows are spread
evenly, and grouping them moves one row per user and task.  A user is in one
of the two tables only, so per-user results are the union of both.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.plans import facts, marts

KEY = "user_id"


@dataclass
class UserTables:
    """Rows of most users in buckets, those of the others as they come."""
    light: DataFrame
    hot: DataFrame

    def both(self) -> DataFrame:
        return self.light.unionByName(self.hot)


def heavy_users(rows: DataFrame, buckets: int) -> list[int]:
    """Users with more rows than an average bucket: fewer than ``buckets``."""
    per_user = rows.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1))).scalar()
    return [r[KEY] for r in per_user.where(F.col("n") * buckets > total).select(KEY).collect()]


def _bucketed(rows: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """A catalog table of ``buckets`` files, each sorted by user."""
    spark = rows.sparkSession
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    (rows.repartition(buckets, KEY).write.mode("overwrite").option("path", path)
     .option("compression", "zstd").bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(name))
    return spark.table(name)


def _plain(rows: DataFrame, path: str) -> DataFrame:
    rows.hint("rebalance").write.mode("overwrite").option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def by_user(rows: DataFrame, name: str, path: str, buckets: int,
            heavy: list[int] | None = None) -> UserTables:
    """Store ``rows`` by user: table ``name`` below ``path`` (a shared folder)."""
    if heavy is None:
        heavy = heavy_users(rows, buckets)
    apart = F.col(KEY).isNull() | F.col(KEY).isin(heavy)
    return UserTables(_bucketed(rows.where(~apart), name, f"{path}/light", buckets),
                      _plain(rows.where(apart), f"{path}/hot"))


def each(tables: UserTables, build: Callable[[DataFrame], DataFrame]) -> UserTables:
    """A per-user result of both tables."""
    return UserTables(build(tables.light), build(tables.hot))


class UserWarehouse:
    """The per-user models on tables laid out by user below ``out_dir``."""

    def __init__(self, stg: DataFrame, out_dir: str, buckets: int, schema: str = "by_user"):
        self.out_dir, self.buckets, self.schema = out_dir.rstrip("/"), buckets, schema
        self.stg = self._store("stg_events", stg)

    def _store(self, name: str, rows: DataFrame | UserTables) -> UserTables:
        table, path = f"{self.schema}.{name}", f"{self.out_dir}/{name}"
        if isinstance(rows, DataFrame):
            return by_user(rows, table, path, self.buckets)
        return UserTables(_bucketed(rows.light, table, f"{path}/light", self.buckets),
                          _plain(rows.hot, f"{path}/hot"))

    def first_dates(self) -> UserTables:
        return each(self.stg, facts.user_first_dates)

    def fact_events(self, first: UserTables) -> UserTables:
        return UserTables(facts.fact_events(self.stg.light, first.light),
                          facts.fact_events(self.stg.hot, first.hot))

    def build(self) -> UserTables:
        """Store first dates and the fact by user; returns the fact."""
        first = self._store("first_dates", self.first_dates())
        self.fact = self._store("fact_events", self.fact_events(first))
        return self.fact

    def rfm(self, k: int = 5) -> DataFrame:
        return marts.rfm_scores(each(self.fact, marts.rfm_users).both(), k)
