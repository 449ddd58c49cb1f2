"""Column expressions shared by the models.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.schema import MONEY, PRICE_BUCKET_EDGES

# Operands of rounded ratios are widened to this type before dividing: the
# quotient then keeps 14 decimals, so one final HALF_UP rounding gives the
# exactly rounded value for any count or cent amount below 10**12.
_RATIO_OPERAND = T.DecimalType(20, 2)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_bucket(price="price") -> Column:
    """Half-open price bands; NULL price is 'unknown'."""
    p = _col(price)
    expr = F.when(p.isNull(), F.lit("unknown"))
    for edge, label in PRICE_BUCKET_EDGES:
        expr = expr.when(p < F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit("500+"))


def revenue(event_type="event_type", price="price") -> Column:
    """Purchase events contribute their price (NULL price counts 0)."""
    zero = F.lit(0).cast(MONEY)
    return (F.when(_col(event_type) == "purchase", F.coalesce(_col(price), zero))
            .otherwise(zero))


def category_level(code="category_code", level: int = 1) -> Column:
    """Dotted hierarchy part; a missing part is '' and NULL stays NULL."""
    return F.split_part(_col(code), F.lit("."), F.lit(level))


def day_of_week(date="event_date") -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(_col(date)) - 1).cast("long")


def hour_of_day(ts="event_timestamp") -> Column:
    return F.hour(_col(ts)).cast("long")


def week_start(date="event_date") -> Column:
    """Monday of the week, as a date."""
    return F.trunc(_col(date), "week")


def month_start(date="event_date") -> Column:
    return F.trunc(_col(date), "month")


def round_ratio(num, den, scale: int = 2, factor: int = 1) -> Column:
    """ROUND(num * factor / den, scale) in exact decimal arithmetic.

    Returns NULL when ``den`` is 0 or NULL (the NULLIF guard); callers that
    want 0 wrap it in ``coalesce`` or a ``when`` on the denominator.
    """
    n = _col(num).cast(_RATIO_OPERAND)
    d = _col(den).cast(_RATIO_OPERAND)
    if factor != 1:
        n = n * F.lit(factor)
    return F.when(d != 0, F.round(n / d, scale))


def ratio_pct(num, den, scale: int = 2) -> Column:
    """Percentage ``num / den * 100`` rounded half away from zero."""
    return round_ratio(num, den, scale=scale, factor=100)


def first_match(rules: Iterable[tuple[Column, object]], default) -> Column:
    """CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... ELSE default END."""
    expr = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if expr is None else expr.otherwise(d)
