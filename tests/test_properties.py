"""Invariants of the models on the sf0.01 tables."""

import os
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.operators.ranking import add_ntiles
from shoplens.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def wh(spark):
    w = Warehouse(spark, SF)
    w.__dict__["fact"] = w.fact.cache()
    return w


def _total(df, col):
    return df.agg(F.sum(col)).first()[0]


def test_funnel_users_bounded_by_segment_users(wh):
    keys = ["event_date", "user_type", "price_bucket", "category_l1"]
    seg = wh.fact.groupBy(*keys).agg(F.count_distinct("user_id").alias("seg_users"))
    j = wh.funnel.join(seg, [wh.funnel[k].eqNullSafe(seg[k]) for k in keys])
    bad = j.where((F.col("view_users") > F.col("seg_users")) | (F.col("cart_users") > F.col("seg_users"))
                  | (F.col("purchase_users") > F.col("seg_users")))
    assert j.count() == wh.funnel.count() and bad.count() == 0


def test_revenue_is_conserved(wh):
    fact_rev = _total(wh.fact, "revenue")
    assert _total(wh.funnel, "revenue") == fact_rev
    assert _total(wh.sessions, "session_revenue") == fact_rev
    uncategorised = _total(wh.fact.where(F.col("category_l1").isNull() | (F.col("category_l1") == "")),
                           "revenue")
    assert _total(wh.growth, "revenue") + uncategorised == fact_rev


def test_week_zero_retention_is_full(wh):
    rows = wh.retention.where(F.col("week_number") == 0).collect()
    assert rows and all(float(r.retention_rate_pct) == 100.0 for r in rows)
    assert sum(r.cohort_size for r in rows) == (
        wh.fact.where("user_id IS NOT NULL").select("user_id").distinct().count())


def test_rfm_quintiles_balanced(wh):
    rfm = wh.rfm.collect()
    for col in ("r_score", "f_score", "m_score"):
        sizes = Counter(getattr(r, col) for r in rfm)
        assert set(sizes) == {1, 2, 3, 4, 5}
        assert max(sizes.values()) - min(sizes.values()) <= 1


def test_sessions_cover_all_events(wh):
    assert _total(wh.sessions, "total_events") == wh.fact.count()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=4), min_size=1, max_size=40),
       st.integers(min_value=2, max_value=7))
def test_distributed_ntile_equals_window(spark, keys, k):
    df = spark.createDataFrame(list(enumerate(keys)), "id long, key long")
    got = {r.id: r.t for r in add_ntiles(df, {"t": ["key", "id"]}, k).collect()}
    want = {r.id: r.t for r in df.select("id", F.ntile(k).over(Window.orderBy("key", "id"))
                                         .alias("t")).collect()}
    assert got == want


def test_segment_sums_never_undercount_true_distincts(wh):
    from shoplens.plans import bi
    summed = {r.event_date: r for r in bi.funnel_by_day(wh.funnel).collect()}
    true = {r.event_date: r for r in bi.true_funnel(wh.fact).collect()}
    assert summed.keys() == true.keys()
    for d, t in true.items():
        s = summed[d]
        assert t.view_users <= s.view_users and t.cart_users <= s.cart_users
        assert t.purchase_users <= s.purchase_users
    dau = {r.event_date: r.dau for r in bi.active_users(wh.fact).collect()}
    assert dau == {r.event_date: r.dau for r in bi.daily_kpi(wh.fact).collect()}
