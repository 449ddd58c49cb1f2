"""Staging model: valid event types, category hierarchy, calendar fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import (category_level, day_of_week, hour_of_day,
                                month_start, week_start)
from shoplens.schema import VALID_EVENT_TYPES


def stg_events(clean: DataFrame) -> DataFrame:
    return (clean
            .where(F.col("event_type").isin(*VALID_EVENT_TYPES))
            .select(
                "event_timestamp", "event_date", "event_type", "product_id",
                "category_id", "category_code",
                category_level("category_code", 1).alias("category_l1"),
                category_level("category_code", 2).alias("category_l2"),
                category_level("category_code", 3).alias("category_l3"),
                "brand", "price", "user_id", "user_session",
                day_of_week("event_date").alias("day_of_week"),
                hour_of_day("event_timestamp").alias("hour_of_day"),
                week_start("event_date").alias("event_week"),
                month_start("event_date").alias("event_month")))


def stg_events_sql(source: str) -> str:
    """The same model as the text of a view over a stored staging table."""
    kinds = ", ".join(f"'{t}'" for t in VALID_EVENT_TYPES)
    levels = ", ".join(f"split_part(category_code, '.', {n}) AS category_l{n}" for n in (1, 2, 3))
    return (f"SELECT event_timestamp, event_date, event_type, product_id, category_id, category_code, {levels}, "
            "brand, price, user_id, user_session, CAST(dayofweek(event_date) - 1 AS BIGINT) AS day_of_week, "
            "CAST(hour(event_timestamp) AS BIGINT) AS hour_of_day, trunc(event_date, 'week') AS event_week, "
            f"trunc(event_date, 'month') AS event_month FROM {source} WHERE event_type IN ({kinds})")
