"""Registered queries: name -> callable(spark, data_dir) -> DataFrame.

Every query starts from the driver's tables in ``data_dir`` (through the
fixture adapter) and runs over all of their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shoplens.functions.output import to_output
from shoplens.plans import bi, checks, ingest, sketches
from shoplens.plans.warehouse import Warehouse
from shoplens.session import apply_core_conf

QueryFn = Callable[[SparkSession, str], DataFrame]

# Parameters of the dashboard keys that take one.
RANGE = {"start_date": "2024-01-22", "end_date": "2024-02-20"}
SINCE_WEEK = "2024-02-12"
AS_OF = "2024-02-15"
DROPOFF_FILTER = {"user_type": "returning", "price_bucket": "50-100"}

# Parameters of the registered sampling operators (the sample is the feature).
SAMPLE_WEEKS = 2
SAMPLE_DAYS = 7


def _q(build: Callable[[Warehouse], DataFrame], name: str) -> QueryFn:
    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        apply_core_conf(spark)
        return to_output(build(Warehouse(spark, data_dir)))
    run.__name__ = name
    return run


_BUILDERS: dict[str, Callable[[Warehouse], DataFrame]] = {
    # ingest and load
    "ingest_clean": lambda w: w.clean,
    "ingest_stats": lambda w: ingest.ingest_stats(w.raw),
    "ingest_sample_weeks": lambda w: ingest.sample_first_weeks(w.clean, SAMPLE_WEEKS),
    "load_sample_days": lambda w: ingest.first_partitions(w.clean, SAMPLE_DAYS),
    "load_staging": lambda w: ingest.staging_frame(w.clean),
    "load_summary": lambda w: ingest.load_summary(ingest.staging_frame(w.clean)),
    # models
    "stg_events": lambda w: w.stg,
    "fact_events": lambda w: w.fact,
    "fact_sessions": lambda w: w.sessions,
    "mart_funnel_daily": lambda w: w.funnel,
    "mart_retention_cohort_weekly": lambda w: w.retention,
    "mart_category_growth_weekly": lambda w: w.growth,
    "mart_rfm": lambda w: w.rfm,
    "mart_price_performance": lambda w: w.price_performance,
    "mart_product_matrix": lambda w: w.product_matrix,
    # quality and validation
    # several layers of one fact: checkpoint it once
    "dq_report": lambda w: checks.model_dq_report(w.share_fact()),
    "check_row_counts": lambda w: checks.row_counts(w.share_fact()),
    "check_date_range": lambda w: checks.date_range(w.fact),
    "check_event_type_mix": lambda w: checks.event_type_mix(w.fact),
    "check_user_type_mix": lambda w: checks.user_type_mix(w.fact),
    "check_latest_funnel": lambda w: checks.latest_funnel(w.funnel),
    "check_first_cohort": lambda w: checks.first_cohort(w.retention),
    "check_top_categories": lambda w: checks.top_categories(w.growth),
    # dashboards
    "bi_kpi_cards": lambda w: bi.kpi_cards(w.fact),
    "bi_daily_kpi": lambda w: bi.daily_kpi(w.fact),
    "bi_funnel_daily": lambda w: bi.funnel_by_day(w.funnel),
    "bi_funnel_user_type": lambda w: bi.funnel_by_user_type(w.funnel),
    "bi_funnel_price": lambda w: bi.funnel_by_price(w.funnel),
    "bi_category_dropoff": lambda w: bi.category_dropoff(w.funnel),
    "bi_cohort_pivot": lambda w: bi.cohort_pivot(w.retention),
    "bi_retention_trend": lambda w: bi.retention_trend(w.retention),
    "bi_category_growth": lambda w: bi.category_growth_listing(w.growth),
    "bi_growth_top": lambda w: bi.growth_extremes(w.growth, top=True),
    "bi_growth_bottom": lambda w: bi.growth_extremes(w.growth, top=False),
    "bi_contribution": lambda w: bi.growth_contribution(w.growth),
    "bi_weekly_monitor": lambda w: bi.weekly_monitor(w.fact),
    "bi_category_alerts": lambda w: bi.category_alerts(w.growth),
    # dashboards with parameters
    "bi_daily_kpi_range": lambda w: bi.daily_kpi(w.fact, **RANGE),
    "bi_funnel_daily_range": lambda w: bi.funnel_by_day(w.funnel, **RANGE),
    "bi_category_dropoff_filtered": lambda w: bi.category_dropoff(w.funnel, **RANGE,
                                                                  **DROPOFF_FILTER),
    "bi_category_growth_since": lambda w: bi.category_growth_listing(w.growth, SINCE_WEEK),
    "bi_kpi_cards_as_of": lambda w: bi.kpi_cards(w.fact, as_of=AS_OF),
    # insights
    "insight_category_cart_rate": lambda w: bi.category_cart_rate(w.funnel, w.growth),
    "insight_user_type_rates": lambda w: bi.user_type_rates(w.funnel),
    "insight_retention": lambda w: bi.retention_listing(w.retention),
    "insight_latest_growth": lambda w: bi.latest_growth_ranking(w.growth),
    "insight_aov_mix": lambda w: bi.aov_mix(w.growth),
    # KPI definitions
    "kpi_dau": lambda w: bi.active_users(w.fact, "event_date", "dau"),
    "kpi_wau": lambda w: bi.active_users(w.fact, "event_week", "wau"),
    "kpi_user_type_daily": lambda w: bi.user_type_daily(w.fact),
    "kpi_funnel": lambda w: bi.true_funnel(w.fact),
    "kpi_aov": lambda w: bi.aov_weekly(w.fact),
    "kpi_arpu": lambda w: bi.arpu_daily(w.fact),
    # any range from daily sketches (exact up to 16,384 users of a range)
    "kpi_trailing_active": lambda w: sketches.trailing_active(w.user_sketches),
    "kpi_new_and_returned": lambda w: sketches.new_and_returned(w.user_sketches),
    # published results
    "rfm_segment_summary": lambda w: bi.rfm_segment_summary(w.rfm),
    "category_revenue_share": lambda w: bi.category_revenue_share(w.growth),
    "headline_kpis": lambda w: bi.headline_kpis(w.fact),
}


def queries() -> dict[str, QueryFn]:
    return {name: _q(b, name) for name, b in _BUILDERS.items()}


def oracle_sql() -> dict[str, str]:
    from shoplens.oracle import ORACLE_SQL
    return dict(ORACLE_SQL)
