"""Tables laid out by user: same results, no exchange on the user."""

import contextlib
import glob
import io
import os

import pytest
from pyspark.sql import functions as F

from shoplens.plans import facts, layout, marts
from shoplens.plans.warehouse import Warehouse, materialize

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
BUCKETS = 8


@pytest.fixture()
def no_broadcast(spark):
    conf = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in conf}
    for k in conf:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _executed(df):
    df.collect()
    with contextlib.redirect_stdout(io.StringIO()):
        plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def _skewed(spark, tmp):
    """A third of the rows on one user, some without a user."""
    stg = Warehouse(spark, SF).stg
    user = F.when(F.col("product_id") % 3 == 0, 17).when(F.col("product_id") % 10 == 1, None).otherwise(F.col("user_id"))
    return materialize(stg.withColumn("user_id", user.cast("long")), tmp + "/stg")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_same_results_and_no_exchange(spark, tmpdir_path, no_broadcast):
    stg = _skewed(spark, tmpdir_path)
    wh = layout.UserWarehouse(stg, tmpdir_path + "/users", BUCKETS, "by_user_a")
    assert 17 in layout.heavy_users(stg, BUCKETS)
    assert wh.stg.light.where("user_id = 17 OR user_id IS NULL").count() == 0
    fact = wh.build()
    plain = facts.fact_events(stg)
    assert fact.both().count() == stg.count() and rows(fact.both().select(*plain.columns)) == rows(plain)
    assert rows(wh.rfm()) == rows(marts.rfm(plain))
    first = wh._store("again", wh.first_dates())
    for name, df in (("first dates", wh.first_dates().light), ("fact", wh.fact_events(first).light),
                     ("rfm", marts.rfm_users(fact.light))):
        plan = _executed(df)
        assert "Exchange" not in plan, f"{name}: {plan}"


def test_no_bucket_holds_a_hot_user(spark, tmpdir_path):
    stg = _skewed(spark, tmpdir_path)
    wh = layout.UserWarehouse(stg, tmpdir_path + "/users", BUCKETS, "by_user_b")
    per_file = sorted(spark.read.parquet(f).count() for f in glob.glob(tmpdir_path + "/users/stg_events/light/*.parquet"))
    assert len(per_file) == BUCKETS and per_file[-1] <= 3 * stg.count() / BUCKETS
    assert len(layout.heavy_users(stg, BUCKETS)) < BUCKETS


def test_empty_table(spark, tmpdir_path):
    stg = _skewed(spark, tmpdir_path).limit(0)
    wh = layout.UserWarehouse(stg, tmpdir_path + "/users", 2, "by_user_c")
    assert wh.build().both().count() == 0 and wh.rfm().count() == 0
