"""Dashboard, insight and KPI queries over the facts and marts.

Parameters that the dashboards take at run time are plain arguments
(``start_date``, ``end_date``, ``category``, ``user_type``,
``price_bucket``); the relative "last 7 days" window takes ``as_of``
instead of the current date so results are reproducible.  ``None`` means
"no filter" for ranges and "derive from the data" for ``as_of`` (latest
event date) and ``category`` (highest-revenue category).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import first_match, ratio_pct, round_ratio, week_start
from shoplens.operators.aggregates import user_stage_flags, users_with
from shoplens.operators.joins import scalar
from shoplens.operators.windows import previous_row, top_k
from shoplens.plans.checks import latest_week

# Dashboard labels.
BUCKET_ORDER = ("0-10", "10-50", "50-100", "100-500", "500+")
WEEKLY_STATUS = {"drop": "⚠️ 급락", "surge": "📈 급등", "normal": "✅ 정상"}
CATEGORY_ALERT = {"drop": "🔴 급락", "caution": "🟡 주의", "surge": "🟢 급성장",
                  "normal": "⚪ 정상"}


def apply_filters(df: DataFrame, start_date=None, end_date=None, category=None,
                  user_type=None, price_bucket=None, date_col: str = "event_date") -> DataFrame:
    """Dashboard filter variables; each is skipped when None.  Range filters
    compare the bare partition column, so they prune date folders."""
    if start_date is not None:
        df = df.where(F.col(date_col) >= F.lit(start_date).cast("date"))
    if end_date is not None:
        df = df.where(F.col(date_col) <= F.lit(end_date).cast("date"))
    if category is not None:
        df = df.where(F.col("category_l1") == category)
    if user_type is not None:
        df = df.where(F.col("user_type") == user_type)
    if price_bucket is not None:
        df = df.where(F.col("price_bucket") == price_bucket)
    return df


def _purchase_price():
    return F.when(F.col("event_type") == "purchase", F.col("price")).otherwise(F.lit(0))


# -- executive overview --------------------------------------------------------------------

def kpi_cards(fact: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """Users, purchasers, revenue and revenue per purchaser (named ``arpu``
    on the dashboard) over the ``days`` days up to ``as_of``."""
    bound = (scalar(fact.agg(F.max("event_date"))) if as_of is None
             else F.lit(as_of).cast("date"))
    recent = fact.where((F.col("event_date") >= F.date_sub(bound, days))
                        & (F.col("event_date") <= bound))
    per_user = user_stage_flags(recent, [], {"_rev": F.sum(_purchase_price())})
    agg = per_user.agg(F.count("user_id").alias("total_users"),
                       users_with("has_purchase").alias("purchasers"),
                       F.sum("_rev").alias("total_revenue"))
    return agg.select("*", round_ratio(F.col("total_revenue"), F.col("purchasers")).alias("arpu"))


def daily_kpi(fact: DataFrame, start_date=None, end_date=None, **filters) -> DataFrame:
    f = apply_filters(fact, start_date, end_date, **filters)
    per_user = user_stage_flags(f, ["event_date"], {"_rev": F.sum("revenue")})
    return (per_user.groupBy("event_date")
            .agg(F.count("user_id").alias("dau"), users_with("has_purchase").alias("purchasers"),
                 F.sum("_rev").alias("revenue"))
            .orderBy("event_date"))


# -- funnel --------------------------------------------------------------------------------

def funnel_rollup(funnel: DataFrame, key: str, start_date=None, end_date=None,
                  with_revenue: bool = False, **filters) -> DataFrame:
    """Re-aggregate the daily funnel mart by one key.  Sums of per-segment
    distinct counts: a user seen in several segments counts once per
    segment (dashboard semantics).  ``filters``: category, user_type,
    price_bucket."""
    f = apply_filters(funnel, start_date, end_date, **filters)
    aggs = [F.sum("view_users").alias("view_users"), F.sum("cart_users").alias("cart_users"),
            F.sum("purchase_users").alias("purchase_users")]
    if with_revenue:
        aggs.append(F.sum("revenue").alias("revenue"))
    g = f.groupBy(key).agg(*aggs)
    v, c, p = F.col("view_users"), F.col("cart_users"), F.col("purchase_users")
    return g.select("*", ratio_pct(c, v).alias("cart_rate_pct"),
                    ratio_pct(p, v).alias("purchase_rate_pct"))


def funnel_by_day(funnel: DataFrame, start_date=None, end_date=None, **filters) -> DataFrame:
    return funnel_rollup(funnel, "event_date", start_date, end_date,
                         **filters).orderBy("event_date")


def funnel_by_user_type(funnel: DataFrame, start_date=None, end_date=None,
                        **filters) -> DataFrame:
    return funnel_rollup(funnel, "user_type", start_date, end_date, **filters)


def funnel_by_price(funnel: DataFrame, start_date=None, end_date=None, **filters) -> DataFrame:
    r = funnel_rollup(funnel, "price_bucket", start_date, end_date, with_revenue=True,
                      **filters)
    rank = first_match([(F.col("price_bucket") == b, i + 1) for i, b in enumerate(BUCKET_ORDER)],
                       len(BUCKET_ORDER) + 1)
    return r.select("price_bucket", "view_users", "cart_users", "purchase_users",
                    "cart_rate_pct", "purchase_rate_pct", "revenue").orderBy(rank, "price_bucket")


def category_dropoff(funnel: DataFrame, start_date=None, end_date=None,
                     limit: int = 15, **filters) -> DataFrame:
    f = (apply_filters(funnel, start_date, end_date, **filters)
         .where(F.col("category_l1").isNotNull()))
    g = f.groupBy("category_l1").agg(F.sum("view_users").alias("view_users"),
                                     F.sum("cart_users").alias("cart_users"),
                                     F.sum("purchase_users").alias("purchase_users"))
    v, c, p = F.col("view_users"), F.col("cart_users"), F.col("purchase_users")
    # (1 - c/v) * 100 == (v - c) / v * 100, rounded once.
    return top_k(g.select("*", ratio_pct(v - c, v).alias("view_to_cart_dropoff_pct"),
                          ratio_pct(c - p, c).alias("cart_to_purchase_dropoff_pct")),
                 [F.desc("view_users"), "category_l1"], limit)


# -- retention -----------------------------------------------------------------------------

def cohort_pivot(retention: DataFrame, weeks: int = 8) -> DataFrame:
    """Retention rate per week number 0..weeks-1 as columns."""
    cells = [F.max(F.when(F.col("week_number") == i, F.col("retention_rate_pct"))).alias(f"week_{i}")
             for i in range(weeks)]
    return (retention.groupBy("cohort_week", "cohort_size").agg(*cells).orderBy("cohort_week"))


def retention_trend(retention: DataFrame) -> DataFrame:
    r = F.col("retention_rate_pct")
    return (retention.groupBy("week_number", "week_label")
            .agg((F.sum(r).cast("double") / F.count(r)).alias("avg_retention_pct"),
                 F.min(r).alias("min_retention_pct"), F.max(r).alias("max_retention_pct"))
            .orderBy("week_number"))


# -- category growth -----------------------------------------------------------------------

def category_growth_listing(growth: DataFrame, start_date=None) -> DataFrame:
    g = apply_filters(growth, start_date, date_col="event_week")
    return (g.select("event_week", "category_l1", "revenue", "revenue_share_pct",
                     "revenue_wow_growth_pct", "purchasers", "aov")
            .orderBy(F.desc("event_week"), F.desc("revenue"), "category_l1"))


def growth_extremes(growth: DataFrame, top: bool = True, limit: int = 10) -> DataFrame:
    g = latest_week(growth).where(F.col("revenue_wow_growth_pct").isNotNull())
    order = F.desc("revenue_wow_growth_pct") if top else F.asc("revenue_wow_growth_pct")
    return top_k(g.select("category_l1", "revenue", "revenue_wow_growth_pct", "revenue_delta"),
                 [order, "category_l1"], limit)


def growth_contribution(growth: DataFrame, limit: int = 15) -> DataFrame:
    """Each category's share of the week's total revenue change."""
    totals = growth.groupBy("event_week").agg(F.sum("revenue_delta").alias("total_delta"))
    last = latest_week(growth).join(totals, "event_week")
    d, t = F.col("revenue_delta"), F.col("total_delta")
    return top_k(last.select("event_week", "category_l1", "revenue_delta", "total_delta",
                             F.when(t != 0, ratio_pct(d, t)).otherwise(F.lit(0))
                              .alias("contribution_pct")),
                 [F.abs(d).desc(), "category_l1"], limit)


def _change_status(cur, prev) -> F.Column:
    """Drop below -20 %, surge above +30 %, compared exactly by cross
    multiplication (no rounded quotient); NULL or zero previous is normal."""
    ratio_lt = F.when(prev > 0, cur * 5 < prev * 4).when(prev < 0, cur * 5 > prev * 4)
    ratio_gt = F.when(prev > 0, cur * 10 > prev * 13).when(prev < 0, cur * 10 < prev * 13)
    return first_match([(ratio_lt, WEEKLY_STATUS["drop"]), (ratio_gt, WEEKLY_STATUS["surge"])],
                       WEEKLY_STATUS["normal"])


def weekly_monitor(fact: DataFrame, weeks: int = 8) -> DataFrame:
    """Weekly users / revenue / purchasers with week-over-week change and a
    status; the lag is taken over all weeks before keeping the latest."""
    f = fact.withColumn("week", week_start("event_date"))
    per_user = user_stage_flags(f, ["week"], {"_rev": F.sum("revenue")})
    weekly = per_user.groupBy("week").agg(F.count("user_id").alias("users"),
                                          F.sum("_rev").alias("revenue"),
                                          users_with("has_purchase").alias("purchasers"))
    # One row per calendar week: a global window over this is bounded.
    w = previous_row(weekly, [], ["week"], {"prev_users": "users", "prev_revenue": "revenue"})
    u, pu, r, pr = F.col("users"), F.col("prev_users"), F.col("revenue"), F.col("prev_revenue")
    return top_k(w.select("week", "users", "revenue", "purchasers", "prev_users", "prev_revenue",
                          ratio_pct(u - pu, pu).alias("users_change_pct"),
                          ratio_pct(r - pr, pr).alias("revenue_change_pct"),
                          _change_status(r, pr).alias("status")),
                 [F.desc("week")], weeks)


def category_alerts(growth: DataFrame, min_revenue: int = 1000) -> DataFrame:
    g = latest_week(growth).where(F.col("revenue") > min_revenue)
    x = F.col("revenue_wow_growth_pct")
    level = first_match([(x < -30, CATEGORY_ALERT["drop"]), (x < -10, CATEGORY_ALERT["caution"]),
                         (x > 50, CATEGORY_ALERT["surge"])], CATEGORY_ALERT["normal"])
    return (g.select("category_l1", "revenue", "revenue_wow_growth_pct", level.alias("alert_level"))
            .orderBy(F.asc_nulls_last("revenue_wow_growth_pct"), "category_l1"))


# -- insights ------------------------------------------------------------------------------

def top_revenue_category(growth: DataFrame) -> DataFrame:
    """One-row frame: the category with the most revenue over all weeks."""
    per_cat = growth.groupBy("category_l1").agg(F.sum("revenue").alias("_r"))
    return per_cat.orderBy(F.desc("_r"), "category_l1").limit(1).select("category_l1")


def _category(growth: DataFrame, category):
    return scalar(top_revenue_category(growth)) if category is None else F.lit(category)


def category_cart_rate(funnel: DataFrame, growth: DataFrame, category=None) -> DataFrame:
    """Cart rate by price bucket for one category, lowest first."""
    f = funnel.where(F.col("category_l1") == _category(growth, category))
    return (f.select("category_l1", "price_bucket", "cart_rate_pct")
            .orderBy("cart_rate_pct", "price_bucket"))


def user_type_rates(funnel: DataFrame) -> DataFrame:
    """Unweighted means of the per-segment rates."""
    def mean(c):
        return F.sum(c).cast("double") / F.count(c)
    return funnel.groupBy("user_type").agg(mean("cart_rate_pct").alias("avg_cart_rate_pct"),
                                           mean("purchase_rate_pct").alias("avg_purchase_rate_pct"))


def retention_listing(retention: DataFrame) -> DataFrame:
    return (retention.select("cohort_week", "week_number", "retention_rate_pct")
            .orderBy("cohort_week", "week_number"))


def latest_growth_ranking(growth: DataFrame) -> DataFrame:
    return (latest_week(growth).select("category_l1", "revenue_delta", "revenue_wow_growth_pct")
            .orderBy(F.desc("revenue_delta"), "category_l1"))


def aov_mix(growth: DataFrame, category=None) -> DataFrame:
    """Overall vs one category's revenue per purchase, by week (unrounded;
    NULL where a week has no purchases)."""
    g = growth
    is_cat = F.col("category_l1") == _category(growth, category)

    def ratio(num, den):
        return F.when(den != 0, num.cast("double") / den)
    rev, cnt = F.sum("revenue"), F.sum("purchase_count")
    crev = F.sum(F.when(is_cat, F.col("revenue")))
    ccnt = F.sum(F.when(is_cat, F.col("purchase_count")))
    return (g.groupBy("event_week")
            .agg(ratio(rev, cnt).alias("overall_aov"), ratio(crev, ccnt).alias("category_aov"))
            .orderBy("event_week"))


# -- KPI definitions -----------------------------------------------------------------------

def active_users(fact: DataFrame, period: str = "event_date", out: str = "dau",
                 approx: bool = False) -> DataFrame:
    """DAU / WAU.  Exact: distinct (period, user) then count.  ``approx``:
    one-pass HyperLogLog++ (``approx_count_distinct``, ~1% error), for
    dashboards that accept it; never used by the checked queries."""
    if approx:
        return fact.groupBy(period).agg(F.approx_count_distinct("user_id").alias(out))
    return (fact.select(period, "user_id").distinct()
            .groupBy(period).agg(F.count("user_id").alias(out)))


def user_type_daily(fact: DataFrame) -> DataFrame:
    return (fact.select("event_date", "user_type", "user_id").distinct()
            .groupBy("event_date", "user_type").agg(F.count("user_id").alias("users")))


def true_funnel(fact: DataFrame, keys=("event_date",)) -> DataFrame:
    """Funnel with real distinct users per key (no segment re-summing)."""
    per_user = user_stage_flags(fact, list(keys))
    g = per_user.groupBy(*keys).agg(users_with("has_view").alias("view_users"),
                                    users_with("has_cart").alias("cart_users"),
                                    users_with("has_purchase").alias("purchase_users"))
    v, c, p = F.col("view_users"), F.col("cart_users"), F.col("purchase_users")
    return g.select("*", ratio_pct(c, v).alias("cart_rate_pct"),
                    ratio_pct(p, v).alias("purchase_rate_pct"),
                    ratio_pct(p, c).alias("cart_to_purchase_rate_pct"))


def aov_weekly(fact: DataFrame) -> DataFrame:
    """AOV = revenue / purchase events; alternative revenue / purchasers."""
    is_p = (F.col("event_type") == "purchase").cast("long")
    per_user = user_stage_flags(fact, ["event_week"], {"_rev": F.sum("revenue"),
                                                       "_n": F.sum(is_p)})
    g = per_user.groupBy("event_week").agg(F.sum("_rev").alias("revenue"),
                                           F.sum("_n").alias("purchase_events"),
                                           users_with("has_purchase").alias("purchasers"))
    r = F.col("revenue")
    return g.select("*", round_ratio(r, F.col("purchase_events")).alias("aov"),
                    round_ratio(r, F.col("purchasers")).alias("revenue_per_purchaser"))


def arpu_daily(fact: DataFrame) -> DataFrame:
    """ARPU = revenue / DAU, next to revenue / purchasers."""
    per_user = user_stage_flags(fact, ["event_date"], {"_rev": F.sum("revenue")})
    g = per_user.groupBy("event_date").agg(F.sum("_rev").alias("revenue"),
                                           F.count("user_id").alias("dau"),
                                           users_with("has_purchase").alias("purchasers"))
    r = F.col("revenue")
    return g.select("*", round_ratio(r, F.col("dau")).alias("arpu"),
                    round_ratio(r, F.col("purchasers")).alias("arppu"))


# -- published results ---------------------------------------------------------------------

def rfm_segment_summary(rfm: DataFrame) -> DataFrame:
    g = rfm.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("users"),
                                       F.sum("monetary").alias("revenue"))
    users, revenue = scalar(rfm.agg(F.count(F.lit(1)))), scalar(rfm.agg(F.sum("monetary")))
    return g.select("*", ratio_pct(F.col("users"), users).alias("user_share_pct"),
                    ratio_pct(F.col("revenue"), revenue).alias("revenue_share_pct"))


def category_revenue_share(growth: DataFrame) -> DataFrame:
    g = growth.groupBy("category_l1").agg(F.sum("revenue").alias("revenue"))
    total = scalar(growth.agg(F.sum("revenue")))
    return (g.select("*", ratio_pct(F.col("revenue"), total).alias("revenue_share_pct"))
            .orderBy(F.desc("revenue"), "category_l1"))


def headline_kpis(fact: DataFrame) -> DataFrame:
    is_p = (F.col("event_type") == "purchase").cast("long")
    per_user = user_stage_flags(fact, [], {"_events": F.count(F.lit(1)),
                                           "_rev": F.sum("revenue"), "_n": F.sum(is_p)})
    g = per_user.agg(F.sum("_events").alias("events"), F.count("user_id").alias("users"),
                     users_with("has_purchase").alias("purchasers"),
                     F.sum("_rev").alias("revenue"), F.sum("_n").alias("purchase_events"))
    return g.select("*", ratio_pct(F.col("purchasers"), F.col("users")).alias("conversion_pct"),
                    round_ratio(F.col("revenue"), F.col("purchase_events")).alias("aov"))
