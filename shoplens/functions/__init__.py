"""Column-level building blocks (all JVM-side built-ins, no Python UDFs)."""

from shoplens.functions.columns import (  # noqa: F401
    category_level,
    day_of_week,
    first_match,
    hour_of_day,
    month_start,
    price_bucket,
    ratio_pct,
    revenue,
    round_ratio,
    week_start,
)
