"""Data-quality rules of the models and the post-build validation checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import ratio_pct
from shoplens.operators.aggregates import share_of_total
from shoplens.operators.joins import scalar
from shoplens.operators.quality import Rule, dq_report
from shoplens.operators.windows import top_k
from shoplens.schema import FUNNEL_STAGES, PRICE_BUCKETS, USER_TYPES, VALID_EVENT_TYPES

# The declared column tests.
MODEL_RULES = {
    "stg_events": [
        Rule("event_timestamp", "not_null"), Rule("event_date", "not_null"),
        Rule("event_type", "not_null"),
        Rule("event_type", "accepted_values", VALID_EVENT_TYPES),
        Rule("user_id", "not_null"), Rule("user_session", "not_null")],
    "fact_events": [
        Rule("event_date", "not_null"), Rule("event_type", "not_null"),
        Rule("user_id", "not_null"),
        Rule("user_type", "accepted_values", USER_TYPES),
        Rule("price_bucket", "accepted_values", PRICE_BUCKETS)],
    "fact_sessions": [
        Rule("user_session", "unique"), Rule("user_session", "not_null"),
        Rule("user_id", "not_null"), Rule("session_date", "not_null"),
        Rule("max_funnel_stage", "accepted_values", FUNNEL_STAGES)],
    "mart_funnel_daily": [Rule("event_date", "not_null")],
    "mart_retention_cohort_weekly": [
        Rule("cohort_week", "not_null"), Rule("week_number", "not_null")],
    "mart_category_growth_weekly": [
        Rule("event_week", "not_null"), Rule("category_l1", "not_null")],
    "mart_rfm": [Rule("user_id", "unique")],
}

ROW_COUNT_TABLES = (
    ("staging.stg_events", "clean"), ("marts.fact_events", "fact"),
    ("marts.fact_sessions", "sessions"), ("marts.mart_funnel_daily", "funnel"),
    ("marts.mart_retention_cohort_weekly", "retention"),
    ("marts.mart_category_growth_weekly", "growth"),
)


def model_dq_report(wh) -> DataFrame:
    tables = {"stg_events": wh.stg, "fact_events": wh.fact, "fact_sessions": wh.sessions,
              "mart_funnel_daily": wh.funnel, "mart_retention_cohort_weekly": wh.retention,
              "mart_category_growth_weekly": wh.growth, "mart_rfm": wh.rfm}
    return dq_report(tables, MODEL_RULES)


def row_counts(wh) -> DataFrame:
    out = None
    for label, attr in ROW_COUNT_TABLES:
        c = getattr(wh, attr).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(label).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


def date_range(fact: DataFrame) -> DataFrame:
    return fact.agg(F.min("event_date").alias("min_date"), F.max("event_date").alias("max_date"),
                    F.count_distinct("event_date").alias("days"))


def event_type_mix(fact: DataFrame) -> DataFrame:
    counts = fact.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))
    return share_of_total(counts, "count", "pct").orderBy(F.desc("count"), "event_type")


def user_type_mix(fact: DataFrame) -> DataFrame:
    """Distinct users per user type; the share is of the *sum* of the
    per-type distincts (a user can be both new and returning)."""
    users = (fact.select("user_type", "user_id").distinct()
             .groupBy("user_type").agg(F.count("user_id").alias("users")))
    return share_of_total(users, "users", "pct")


def latest_funnel(funnel: DataFrame) -> DataFrame:
    """Sums of the newest day, found among the per-day sums (one pass)."""
    days = funnel.groupBy("event_date").agg(
        F.sum("view_users").alias("view_users"), F.sum("cart_users").alias("cart_users"),
        F.sum("purchase_users").alias("purchase_users"))
    s = days.orderBy(F.desc("event_date")).limit(1).drop("event_date")
    return s.select("*", ratio_pct(F.col("cart_users"), F.col("view_users")).alias("cart_rate"),
                    ratio_pct(F.col("purchase_users"), F.col("view_users")).alias("purchase_rate"))


def first_cohort(retention: DataFrame, limit: int = 8) -> DataFrame:
    first = scalar(retention.agg(F.min("cohort_week")))
    return (retention.where(F.col("cohort_week") == first)
            .select("cohort_week", "week_number", "cohort_size", "active_users",
                    "retention_rate_pct")
            .transform(lambda d: top_k(d, ["week_number"], limit)))


def latest_week(growth: DataFrame) -> DataFrame:
    return growth.where(F.col("event_week") == scalar(growth.agg(F.max("event_week"))))


def top_categories(growth: DataFrame, limit: int = 10) -> DataFrame:
    return top_k(latest_week(growth).select("category_l1", "revenue", "revenue_share_pct",
                                            "purchasers"),
                 [F.desc("revenue"), "category_l1"], limit)


# Post-build validation checks, in run order.
VALIDATIONS = {
    "row_counts": lambda wh: row_counts(wh),
    "date_range": lambda wh: date_range(wh.fact),
    "event_type_mix": lambda wh: event_type_mix(wh.fact),
    "user_type_mix": lambda wh: user_type_mix(wh.fact),
    "latest_funnel": lambda wh: latest_funnel(wh.funnel),
    "first_cohort": lambda wh: first_cohort(wh.retention),
    "top_categories": lambda wh: top_categories(wh.growth),
}


def validate(wh, check: str = "all") -> dict[str, object]:
    """Run one named check or all of them.  Each check is isolated: a failure
    is reported as its exception instead of stopping the others."""
    names = list(VALIDATIONS) if check == "all" else [check]
    results: dict[str, object] = {}
    for name in names:
        try:
            results[name] = VALIDATIONS[name](wh).collect()
        except Exception as exc:  # noqa: BLE001 - reported per check
            results[name] = exc
    return results
