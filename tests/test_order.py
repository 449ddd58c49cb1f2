"""The row order that ordered queries promise, and limits that cut."""

import os

import pytest

from shoplens import registry
from shoplens.plans.bi import BUCKET_ORDER

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def rows(spark, name):
    return registry.queries()[name](spark, SF).collect()


def test_order_by_date(spark):
    for name, column in (("bi_daily_kpi", "event_date"), ("bi_cohort_pivot", "cohort_week"),
                         ("insight_aov_mix", "event_week")):
        got = [r[column] for r in rows(spark, name)]
        assert len(got) > 1 and got == sorted(got)


def test_order_by_case(spark):
    got = [r.price_bucket for r in rows(spark, "bi_funnel_price")]
    assert got == [*BUCKET_ORDER, "unknown"]


def test_order_by_abs_and_limit(spark):
    got = rows(spark, "bi_contribution")
    size = [abs(r.revenue_delta) for r in got]
    assert len(got) == 15 and size == sorted(size, reverse=True)
    assert min(r.revenue_delta for r in got) < 0 < max(r.revenue_delta for r in got)


def test_limits_cut(spark):
    categories = len({r.category_l1 for r in rows(spark, "mart_category_growth_weekly")})
    assert categories >= 20
    assert len(rows(spark, "bi_category_dropoff")) == 15
    assert len(rows(spark, "check_top_categories")) == len(rows(spark, "bi_growth_top")) == 10
    assert len(rows(spark, "bi_weekly_monitor")) == len(rows(spark, "check_first_cohort")) == 8


def test_rules_are_reached(spark):
    assert len({r.alert_level for r in rows(spark, "bi_category_alerts")}) == 4
    assert len({r.rfm_segment for r in rows(spark, "mart_rfm")}) == 7
    pivot = rows(spark, "bi_cohort_pivot")
    assert any(r.week_5 is not None and r.week_7 is not None for r in pivot)
    failures = {(r.table_name, r.column_name, r.test_name): r.failures for r in rows(spark, "dq_report")}
    assert failures["fact_events", "user_id", "not_null"] > 0
    assert failures["stg_events", "user_session", "not_null"] > 0
    assert failures["fact_sessions", "user_session", "unique"] > 0
    assert failures["mart_rfm", "user_id", "unique"] == 0
