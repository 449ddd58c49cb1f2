"""The six marts, each derived from ``fact_events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions import first_match, ratio_pct, round_ratio
from shoplens.operators.aggregates import (STAGE_TYPES, tagged_ids, user_stage_flags,
                                           users_with)
from shoplens.operators.joins import scalar
from shoplens.operators.ranking import add_ntiles, percentiles_cont, survey
from shoplens.operators.windows import previous_row
from shoplens.session import reliable

# Segment and quadrant labels.
RFM_SEGMENTS = ("Champions", "Loyal Customers", "Potentials", "New Customers",
                "At Risk", "Lost", "Others")
QUADRANTS = ("Star (High View, High Rev)", "Problem Child (High View, Low Rev)",
             "Cash Cow (Low View, High Rev)", "Dog (Low View, Low Rev)")
RECENT_DAYS = 7
MIN_PRODUCT_VIEWS = 10


def _zero_if_null(c):
    return F.coalesce(c, F.lit(0))


def funnel_daily(fact: DataFrame) -> DataFrame:
    """Daily funnel per (date, user type, price bucket, category)."""
    keys = ["event_date", "user_type", "price_bucket", "category_l1"]
    purchase_rev = F.when(F.col("event_type") == "purchase", F.col("revenue")).otherwise(F.lit(0))
    per_user = user_stage_flags(fact, keys, {"user_revenue": F.sum(purchase_rev)})
    buyer_rev = F.when(F.col("has_purchase") == 1, F.col("user_revenue"))
    agg = per_user.groupBy(*keys).agg(
        users_with("has_view").alias("view_users"),
        users_with("has_cart").alias("cart_users"),
        users_with("has_purchase").alias("purchase_users"),
        F.sum("user_revenue").alias("revenue"),
        (F.sum(buyer_rev).cast("double") / F.count(buyer_rev)).alias("avg_revenue_per_purchaser"))
    v, c, p = F.col("view_users"), F.col("cart_users"), F.col("purchase_users")
    return agg.select(
        *keys, "view_users", "cart_users", "purchase_users", "revenue",
        "avg_revenue_per_purchaser",
        F.when(v > 0, ratio_pct(c, v)).otherwise(F.lit(0)).alias("cart_rate_pct"),
        F.when(v > 0, ratio_pct(p, v)).otherwise(F.lit(0)).alias("purchase_rate_pct"),
        F.when(c > 0, ratio_pct(p, c)).otherwise(F.lit(0)).alias("cart_to_purchase_rate_pct"))


WEEK_BITS = 64


def user_week_bits(fact: DataFrame) -> DataFrame:
    """(user_id, word, cohort, weeks): the weeks a user was active in, as the
    bits of one long per ``WEEK_BITS`` weeks; weeks are numbered from Monday,
    1970-01-05.  The bits are merged map-side, so a user costs one row per
    task and word, however many events there are."""
    def week(day: str):
        # Exact for dates before 1970 as well: floor, not truncation.
        return F.floor((F.unix_date(F.col(day)) - 4) / 7).cast("int")

    active = fact.where(F.col("user_id").isNotNull()).select(
        "user_id", week("event_date").alias("_week"), week("first_event_date").alias("_cohort"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("_week", F.lit(WEEK_BITS)))
    return (active.groupBy("user_id", F.floor(F.col("_week") / WEEK_BITS).cast("int").alias("word"))
            .agg(F.bit_or(bit).alias("weeks"), F.min("_cohort").alias("cohort")))


def retention_cohort_weekly(fact: DataFrame) -> DataFrame:
    """Weekly cohorts from the users' week bits: users with equal cohort and
    bits are counted as one row before the bits are taken apart, so the
    second shuffle has one row per pattern and task.  The cohort size equals
    the week-0 count (every user is active in the cohort week), so no second
    pass."""
    patterns = (user_week_bits(fact).groupBy("cohort", "word", "weeks")
                .agg(F.count(F.lit(1)).alias("users")))
    bits = F.array(*[F.lit(b) for b in range(WEEK_BITS)])
    active = F.filter(bits, lambda b: F.getbit("weeks", b) == 1)
    weekly = (patterns.select("cohort", "word", "users", F.explode(active).alias("_bit"))
              .groupBy(F.date_add(F.lit("1970-01-05").cast("date"), F.col("cohort") * 7).alias("cohort_week"),
                       (F.col("word") * WEEK_BITS + F.col("_bit") - F.col("cohort")).cast("long")
                       .alias("week_number"))
              .agg(F.sum("users").alias("active_users")))
    # (cohort, week number) rows only: a window over this small result.
    cohort = Window.partitionBy("cohort_week")
    r = weekly.withColumn("cohort_size", F.max(
        F.when(F.col("week_number") == 0, F.col("active_users"))).over(cohort))
    wn = F.col("week_number")
    return r.select(
        "cohort_week", "week_number", "cohort_size", "active_users",
        ratio_pct(F.col("active_users"), F.col("cohort_size")).alias("retention_rate_pct"),
        F.when(wn == 0, F.lit("Week 0 (Cohort)"))
         .otherwise(F.concat(F.lit("Week "), wn.cast("string"))).alias("week_label"))


def category_growth_weekly(fact: DataFrame) -> DataFrame:
    """Weekly category metrics with revenue share and week-over-week growth.
    Distinct users and products are counted in one pass over tagged ids.
    LAG takes the previous *present* week of the category."""
    keys = ["event_week", "category_l1"]
    cat = fact.where(F.col("category_l1").isNotNull() & (F.col("category_l1") != ""))
    is_type = {t: F.col("event_type") == t for t in STAGE_TYPES}
    ids = tagged_ids(cat, keys, {"user": "user_id", "product": "product_id"}, {"user": {
        **{f"has_{t}": (c.cast("int"), F.max) for t, c in is_type.items()},
        "_purchases": (is_type["purchase"].cast("long"), F.sum),
        "_revenue": (F.col("revenue"), F.sum)}})

    def users(condition=F.lit(True)):
        return F.count_if((F.col("kind") == "user") & F.col("id").isNotNull() & condition)

    weekly = ids.groupBy(*keys).agg(
        users().alias("unique_users"),
        users(F.col("has_view") == 1).alias("view_users"),
        users(F.col("has_cart") == 1).alias("cart_users"),
        users(F.col("has_purchase") == 1).alias("purchasers"),
        F.sum("_purchases").alias("purchase_count"),
        F.sum("_revenue").alias("revenue"),
        F.count_if((F.col("kind") == "product") & F.col("id").isNotNull()).alias("unique_products"))
    # Small frame from here on: (weeks x categories) rows.
    week = Window.partitionBy("event_week")
    w = previous_row(weekly.withColumn("total_revenue", F.sum("revenue").over(week)),
                     ["category_l1"], ["event_week"],
                     {"prev_week_revenue": "revenue", "prev_week_purchasers": "purchasers"})
    rev, tot = F.col("revenue"), F.col("total_revenue")
    prev_r, prev_p = F.col("prev_week_revenue"), F.col("prev_week_purchasers")
    return w.select(
        *keys, "unique_users", "view_users", "cart_users", "purchasers", "purchase_count",
        "revenue", "unique_products",
        F.when(tot > 0, ratio_pct(rev, tot)).otherwise(F.lit(0)).alias("revenue_share_pct"),
        F.when(F.col("view_users") > 0, ratio_pct(F.col("purchasers"), F.col("view_users")))
         .otherwise(F.lit(0)).alias("purchase_conversion_pct"),
        F.when(F.col("purchase_count") > 0, round_ratio(rev, F.col("purchase_count")))
         .otherwise(F.lit(0)).alias("aov"),
        F.when(prev_r > 0, ratio_pct(rev - prev_r, prev_r)).alias("revenue_wow_growth_pct"),
        F.when(prev_p > 0, ratio_pct(F.col("purchasers") - prev_p, prev_p))
         .alias("purchasers_wow_growth_pct"),
        (rev - F.coalesce(prev_r, F.lit(0))).alias("revenue_delta"))


def rfm_users(fact: DataFrame) -> DataFrame:
    """One row per user: last day, purchase sessions, purchase value."""
    bought = F.col("event_type") == "purchase"
    return fact.groupBy("user_id").agg(
        F.max("event_date").alias("last_seen_date"),
        F.count_distinct(F.when(bought, F.col("user_session"))).alias("frequency"),
        _zero_if_null(F.sum(F.when(bought, F.col("price")).otherwise(F.lit(0)))).alias("monetary"))


def rfm(fact: DataFrame, k: int = 5) -> DataFrame:
    """Recency / frequency / monetary quintiles and segments of ``fact``."""
    return rfm_scores(rfm_users(fact), k)


def rfm_scores(users: DataFrame, k: int = 5) -> DataFrame:
    """The mart from ``rfm_users``.  NTILE ties are broken by user_id
    ascending (a NULL user, one group, first); the quintile bounds come from
    the exact selection of the ranking operator, never from a global window.
    Its first scan also gives the newest date."""
    per_user = reliable(users).withColumn("_day", F.unix_date("last_seen_date"))
    known = survey(per_user, ["_day", "frequency", "monetary"])
    newest = F.lit(int(known["_day"]["high"] or 0))
    # The longest recency is the earliest day, so its ascending order is the
    # days' own.
    scored = add_ntiles(per_user, {
        "r_score": ["_day", "user_id"],
        "f_score": ["frequency", "user_id"],
        "m_score": ["monetary", "user_id"]}, k, stored=True, known=known)
    scored = (scored.withColumn("recency_days", (newest - F.col("_day")).cast("long"))
              .withColumn("_recent", F.col("recency_days") <= RECENT_DAYS))
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    recent = F.col("_recent")
    champions, loyal, potentials, new, at_risk, lost, others = RFM_SEGMENTS
    segment = first_match([
        ((r >= 5) & (f >= 5) & (m >= 5), champions),
        ((r >= 4) & (f >= 4) & (m >= 4), loyal),
        ((r >= 3) & (f >= 3) & (m >= 3), potentials),
        ((r <= 2) & recent, new),
        ((r <= 2) & (f >= 4), at_risk),
        ((r <= 2) & (f <= 2), lost),
    ], others)
    return scored.select(
        "user_id", "monetary", "frequency", "last_seen_date", "recency_days",
        "r_score", "f_score", "m_score",
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_score"),
        segment.alias("rfm_segment"))


def price_performance(fact: DataFrame) -> DataFrame:
    """Funnel per (price bucket, category) over all time; NULL on zero
    denominators.  (The outer re-aggregation of the original is an identity
    and is skipped.)"""
    keys = ["price_bucket", "category_l1"]
    src = fact.where(F.col("price_bucket").isNotNull())
    purchase_price = F.when(F.col("event_type") == "purchase", F.col("price")).otherwise(F.lit(0))
    per_user = user_stage_flags(src, keys, {"_revenue": F.sum(purchase_price)})
    agg = per_user.groupBy(*keys).agg(
        users_with("has_view").alias("view_users"),
        users_with("has_cart").alias("cart_users"),
        users_with("has_purchase").alias("purchase_users"),
        F.sum("_revenue").alias("revenue"))
    v, c, p = F.col("view_users"), F.col("cart_users"), F.col("purchase_users")
    return agg.select(
        *keys, "view_users", "cart_users", "purchase_users", "revenue",
        ratio_pct(c, v).alias("view_to_cart_rate"),
        ratio_pct(p, c).alias("cart_to_purchase_rate"),
        ratio_pct(p, v).alias("overall_conversion_rate"),
        round_ratio(F.col("revenue"), v).alias("revenue_per_viewer"))


def product_matrix(fact: DataFrame, exact: bool = True) -> DataFrame:
    """Popularity vs revenue quadrants.  Medians are exact PERCENTILE_CONT
    over *all* products (one search for both columns over the stored
    metrics), the noise filter applies after.  ``exact=False`` uses
    ``percentile_approx`` (one pass, bounded sketch)."""
    et = F.col("event_type")
    metrics = (fact.where(F.col("product_id").isNotNull())
               .groupBy("product_id", "category_l1", "brand").agg(
                   F.count_if(et == "view").alias("view_count"),
                   F.count_if(et == "cart").alias("cart_count"),
                   F.count_if(et == "purchase").alias("purchase_count"),
                   F.sum(F.when(et == "purchase", F.col("price")).otherwise(F.lit(0)))
                    .alias("revenue")))
    metrics = reliable(metrics)
    if exact:
        medians = percentiles_cont(metrics, ["view_count", "revenue"], 0.5)
        med_v, med_r = (F.lit(medians[c]).cast("double") for c in ("view_count", "revenue"))
    else:
        med_v = scalar(metrics.agg(F.percentile_approx("view_count", 0.5)))
        med_r = scalar(metrics.agg(F.percentile_approx("revenue", 0.5)))
    vc, rev = F.col("view_count"), F.col("revenue")
    # Each median is referenced once; NOT (x > m) is x <= m, NULL stays NULL.
    m = metrics.withColumn("_hi_v", vc > med_v).withColumn("_hi_r", rev > med_r)
    hi_v, hi_r = F.col("_hi_v"), F.col("_hi_r")
    lo_v, lo_r = ~hi_v, ~hi_r
    quadrant = first_match([
        (hi_v & hi_r, QUADRANTS[0]),
        (hi_v & lo_r, QUADRANTS[1]),
        (lo_v & hi_r, QUADRANTS[2]),
    ], QUADRANTS[3])
    return (m.where(vc > MIN_PRODUCT_VIEWS)
            .select("product_id", "category_l1",
                    F.coalesce(F.col("brand"), F.lit("Unknown")).alias("brand"),
                    "view_count", "cart_count", "purchase_count", "revenue",
                    ratio_pct(F.col("purchase_count"), vc).alias("conversion_rate"),
                    round_ratio(rev, F.col("purchase_count")).alias("avg_price"),
                    quadrant.alias("matrix_quadrant")))
