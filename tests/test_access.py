"""How much of a stored layer a lookup reads."""

import pytest
from pyspark.sql import functions as F

from shoplens.plans.warehouse import LAYOUTS, materialize


def rows_read(df):
    """Rows that the scan handed on after pruning folders and row groups."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().executedPlan().executeCollect()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    n = 60_000
    events = spark.range(0, n, 1, 4).select(
        F.expr("date'2024-01-01' + cast(id % 2 as int)").alias("event_date"),
        F.concat(F.lit("c"), (F.hash("id") % 12).cast("string")).alias("category_l1"),
        (F.pmod(F.hash("id"), F.lit(12)) * 1000 + F.pmod(F.hash("id", F.lit(1)), F.lit(400))).cast("long").alias("product_id"),
        F.pmod(F.hash("id", F.lit(2)), F.lit(5000)).cast("long").alias("user_id"),
        F.sha1((F.col("id") / 3).cast("long").cast("string")).alias("user_session"),
        F.lit(1.0).alias("price"))
    # Row groups of a thousand rows or so, as a large date has many.
    stored = materialize(events, str(tmp_path_factory.mktemp("fact")), layout=LAYOUTS["fact"],
                         parquet__block__size=64 * 1024)
    return stored, n


def test_lookups_read_a_part_of_the_rows(spark, fact):
    stored, n = fact
    one = stored.where("event_date = DATE'2024-01-02'").orderBy("user_session").first()
    day = F.col("event_date") == one.event_date
    whole = rows_read(stored.where(day))
    assert whole == n // 2
    for column, share in (("user_session", 0.25), ("category_l1", 0.3), ("product_id", 0.25)):
        found = stored.where(day & (F.col(column) == one[column]))
        assert rows_read(found) <= share * whole, column
        assert found.count() == sum(r[column] == one[column] for r in stored.where(day).collect())
    missing = stored.where(F.col("user_session") == "no such session")
    assert rows_read(missing) <= 0.05 * n


def test_all_dates_are_searched_by_session(spark, fact):
    stored, n = fact
    session = stored.first().user_session
    assert rows_read(stored.where(F.col("user_session") == session)) <= 0.25 * n
