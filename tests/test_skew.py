"""Aggregates of a row's own key, with hot and missing keys."""

import random

import pytest
from pyspark.sql import functions as F

from shoplens.operators.skew import with_key_aggregate
from shoplens.plans import facts
from shoplens.plans.staging import stg_events


@pytest.fixture()
def small_partitions(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("hot", [0.0, 0.4, 0.9, 1.0])
def test_equals_brute_force(spark, small_partitions, hot):
    rng = random.Random(int(hot * 10))
    rows = [(rng.choice([7, 7, 8, None]) if rng.random() < hot else rng.choice([None, *range(300)]), rng.randrange(10 ** 6))
            for _ in range(3000)] + [(5, 1)] * 3
    df = spark.createDataFrame(rows, "k long, v long")
    out = with_key_aggregate(df, "k", F.min("v"), "low", ["v"])
    assert out.columns == ["k", "v", "low"]
    low = {}
    for k, v in rows:
        low[k] = min(v, low.get(k, v))
    want = sorted(((k, v, None if k is None else low[k]) for k, v in rows), key=str)
    assert sorted((tuple(r) for r in out.collect()), key=str) == want


def test_empty_and_lone_rows(spark):
    df = spark.createDataFrame([], "k long, v long")
    assert with_key_aggregate(df, "k", F.max("v"), "top", ["v"]).count() == 0
    one = spark.createDataFrame([(None, 3)], "k long, v long")
    assert [tuple(r) for r in with_key_aggregate(one, "k", F.max("v"), "top", ["v"]).collect()] == [(None, 3, None)]


def _events(spark, user):
    return stg_events(spark.range(0, 120_000, 1, 8).select(
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id)").alias("event_timestamp"),
        F.expr("date'2024-01-01' + cast(id % 20 as int)").alias("event_date"),
        F.lit("view").alias("event_type"), (F.col("id") % 50).alias("product_id"),
        F.lit(1).cast("long").alias("category_id"), F.lit("a.b").alias("category_code"),
        F.lit("x").alias("brand"), F.lit(1).cast("decimal(12,2)").alias("price"),
        F.expr(user).cast("long").alias("user_id"), F.col("id").cast("string").alias("user_session")))


@pytest.mark.parametrize("user", [
    "if(id % 10 != 0, 1, id)",                      # 90 % on one user
    "if(id % 10 != 0, null, id)",                   # 90 % without a user
    "if(id % 3 < 2, 5 + id % 3, id)"])              # two of a third each
def test_lazy_fact_spreads_hot_users(spark, small_partitions, user):
    """In one lazy query no task joins more than twice the median's rows."""
    fact = facts.fact_events(_events(spark, user))
    per_task = sorted(r.n for r in fact.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count("*").alias("n"), F.max("first_event_date")).collect())
    assert len(per_task) == 16 and sum(per_task) == 120_000
    assert per_task[-1] <= 2 * per_task[len(per_task) // 2]
    assert fact.where("user_id IS NULL").where("first_event_date IS NOT NULL").count() == 0
    assert fact.where("user_type = 'new'").count() == fact.where("event_date = first_event_date").count() > 0
