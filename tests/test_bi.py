"""Dashboard parameters and approximate options."""

import pytest
from pyspark.sql import functions as F

from shoplens.plans import bi, marts
from shoplens.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse(spark, SF)


def test_filters_restrict_rollups(wh):
    everything = {r.user_type: r for r in bi.funnel_by_user_type(wh.funnel).collect()}
    only_new = bi.funnel_by_user_type(wh.funnel, user_type="new").collect()
    assert [r.user_type for r in only_new] == ["new"]
    assert only_new[0].view_users == everything["new"].view_users
    days = bi.funnel_by_day(wh.funnel, start_date="2024-01-10", end_date="2024-01-12").collect()
    assert [str(r.event_date) for r in days] == ["2024-01-10", "2024-01-11", "2024-01-12"]
    bucket = bi.funnel_by_price(wh.funnel, price_bucket="0-10").collect()
    assert [r.price_bucket for r in bucket] == ["0-10"]


def test_kpi_cards_as_of(wh):
    last = wh.fact.agg(F.max("event_date")).first()[0]
    default = bi.kpi_cards(wh.fact).first()
    explicit = bi.kpi_cards(wh.fact, as_of=str(last)).first()
    assert default == explicit
    early = bi.kpi_cards(wh.fact, as_of="2024-01-03").first()
    window = wh.fact.where((F.col("event_date") >= "2023-12-27") & (F.col("event_date") <= "2024-01-03"))
    assert early.total_users == window.select("user_id").distinct().count()
    assert early.purchasers == (window.where(F.col("event_type") == "purchase")
                                .select("user_id").distinct().count())


def test_approximate_distinct_is_close(wh):
    exact = {r.event_date: r.dau for r in bi.active_users(wh.fact).collect()}
    approx = {r.event_date: r.dau for r in bi.active_users(wh.fact, approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[d] - exact[d]) <= max(2, 0.05 * exact[d]) for d in exact)


def test_product_matrix_approx_medians(spark):
    big = Warehouse(spark, "/root/testdata/sf0.01")
    exact = {r.product_id: r.matrix_quadrant for r in marts.product_matrix(big.fact).collect()}
    approx = {r.product_id: r.matrix_quadrant
              for r in marts.product_matrix(big.fact, exact=False).collect()}
    assert exact.keys() == approx.keys()
    same = sum(exact[k] == approx[k] for k in exact)
    assert same >= 0.8 * len(exact)


def test_category_parameter(wh):
    top = bi.top_revenue_category(wh.growth).first()[0]
    by_default = bi.category_cart_rate(wh.funnel, wh.growth).collect()
    explicit = bi.category_cart_rate(wh.funnel, wh.growth, category=top).collect()
    assert sorted(map(tuple, by_default)) == sorted(map(tuple, explicit))
    assert all(r.category_l1 == top for r in explicit)
