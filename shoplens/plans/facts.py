"""Fact models: enriched events and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import first_match, price_bucket, revenue
from shoplens.operators.skew import with_key_aggregate


def user_first_dates(stg: DataFrame) -> DataFrame:
    """One row per user: first event date (map-side partial min, so a hot
    user costs one row per task before the shuffle)."""
    return stg.groupBy("user_id").agg(F.min("event_date").alias("first_event_date"))


def fact_events(stg: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """Staging events + price bucket, first event date, user type, revenue.

    The first date is the smallest of the user's; a NULL user has none and
    counts as returning.  With ``first`` (``user_first_dates`` as a stored
    table) it comes from a left join, which adaptive execution splits where a
    user is hot.  Without it the dates are found in the same plan, and hot
    users are dealt out there.
    """
    joined = (with_key_aggregate(stg, "user_id", F.min("event_date"), "first_event_date",
                                 ["event_timestamp", "event_type"])
              if first is None else stg.join(first, on="user_id", how="left"))
    return joined.select(
        "event_timestamp", "event_date", "event_week", "event_month", "event_type",
        "product_id", "category_id", "category_code", "category_l1", "category_l2",
        "brand", "price", "user_id", "user_session", "day_of_week", "hour_of_day",
        price_bucket("price").alias("price_bucket"),
        "first_event_date",
        F.when(F.col("event_date") == F.col("first_event_date"), F.lit("new"))
         .otherwise(F.lit("returning")).alias("user_type"),
        revenue("event_type", "price").alias("revenue"))


def fact_sessions(fact: DataFrame) -> DataFrame:
    """One row per (user_session, user_id); a session id shared by two users
    gives two rows.  ``products_viewed`` counts distinct products of any
    event type (single distinct column: Catalyst plans it as two partial
    aggregations, no Expand)."""
    et = F.col("event_type")
    stage = first_match([(et == "purchase", 3), (et == "cart", 2), (et == "view", 1)], 0)
    agg = fact.groupBy("user_session", "user_id").agg(
        F.min("event_date").alias("session_date"),
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("product_id").alias("products_viewed"),
        F.count_if(et == "view").alias("view_count"),
        F.count_if(et == "cart").alias("cart_count"),
        F.count_if(et == "purchase").alias("purchase_count"),
        F.sum(revenue("event_type", "price")).alias("session_revenue"),
        F.max(stage).cast("long").alias("max_funnel_stage"))
    v, c, p = F.col("view_count"), F.col("cart_count"), F.col("purchase_count")
    return agg.select(
        "user_session", "user_id", "session_date", "session_start", "session_end",
        (F.expr("timestampdiff(MICROSECOND, session_start, session_end)").cast("double")
         / F.lit(60_000_000.0)).alias("session_duration_minutes"),
        "total_events", "products_viewed", "view_count", "cart_count", "purchase_count",
        "session_revenue", "max_funnel_stage",
        (c > 0).alias("has_cart"),
        (p > 0).alias("has_purchase"),
        F.when((v > 0) & (c > 0), c.cast("double") / v).otherwise(F.lit(0.0))
         .alias("view_to_cart_rate"),
        F.when((c > 0) & (p > 0), p.cast("double") / c).otherwise(F.lit(0.0))
         .alias("cart_to_purchase_rate"))
