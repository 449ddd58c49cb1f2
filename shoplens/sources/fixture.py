"""Adapter: derive the raw clickstream contract from the driver's tables.

The test data has ``events(event_id, ts, user_id, event_type, value, props)``
and ``part``, but no product, category, price or session columns.  These
deterministic rules shape them into the raw contract (event_time,
event_type, product_id, category_id, category_code, brand, price, user_id,
user_session) so that every model, edge case and segment is exercised.
Every input row gives one raw row.  The cohort rules move a row to another
user (``user_id % 10 + 1,000,000 * zone``) instead of dropping it, so weekly
cohorts, churned users and retention gaps exist among all rows.  The DuckDB
oracle repeats the same rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators.joins import join_dimension
from shoplens.sources.tables import read_table

# Fixed values of the adapter rules.
EPOCH_DAY = "2024-01-01"          # day 0 of the synthetic stream
REPEAT_DAYS = 30                  # a third of the events each in days 0-, 30- and 60-
SESSION_SECONDS = 129600          # 36-hour session ids, so sessions cross midnight
SHARED_SESSION_UPTO = 4           # users 0..4 share session ids
ZONE_STEP = 1_000_000             # distance of the user ids of the zones
ZONE_USERS = 10                   # users of each zone other than 0
CHURN_DAY = 55                    # first day without every fifth user (plus 7 a cohort)
NULL_TYPE_EVERY = 211             # event_id divisible: NULL event type
NULL_TIME_EVERY = 331             # ... NULL time
NULL_USER_EVERY = 401             # ... NULL user
NULL_SESSION_EVERY = 419          # ... NULL session
NULL_PRODUCT_EVERY = 433          # ... NULL product
PRICE_RULE_MOD = 97               # remainders 0..6: the price rules below
TYPE_MAP = {"click": "cart", "signup": "view"}


def raw_events(events: DataFrame, part: DataFrame) -> DataFrame:
    """Raw contract rows from ``events`` LEFT JOIN ``part`` on the props key."""
    eid, uid = F.col("event_id"), F.col("user_id")
    base = (events
            .select("event_id", "ts", "user_id", "event_type", "value",
                    F.get_json_object("props", "$.k").cast("long").alias("k"))
            .withColumn("time", F.expr(
                f"timestampadd(DAY, cast({REPEAT_DAYS} * (event_id % 3) as int), ts)"))
            .withColumn("dy", F.datediff(F.to_date("time"), F.lit(EPOCH_DAY).cast("date"))))
    dim = part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    joined = join_dimension(base, dim, base["k"] == dim["p_partkey"], "left")
    dy, null_string = F.col("dy"), F.lit(None).cast("string")

    zone = (F.when(dy < 7 * (uid % 4), 1)
            .when((uid % 5 == 0) & (dy >= CHURN_DAY + 7 * (uid % 4)), 2)
            .when((uid % 3 == 0) & dy.between(14, 20), 3)
            .otherwise(0))

    def unless(every: int, value):
        return F.when(eid % every != 0, value)

    etype = F.col("event_type")
    mapped_type = F.when(eid % NULL_TYPE_EVERY == 0, null_string)
    for src, dst in TYPE_MAP.items():
        mapped_type = mapped_type.when(etype == src, F.lit(dst))
    mapped_type = mapped_type.otherwise(etype)

    size = F.col("p_size")
    code = (F.when(size % 8 == 0, null_string)
            .when(size % 8 == 1, F.lit(""))
            .when((F.col("p_type") == "PROMO") & dy.between(7, 13), null_string)
            .otherwise(F.concat(F.lower("p_type"), F.lit("_"), (size % 8).cast("string"),
                                F.lit("."), F.translate("p_name", " ", "."))))

    value = F.col("value")
    rule = eid % PRICE_RULE_MOD
    price = (F.when(rule == 0, F.lit(None).cast("double"))
             .when(rule == 1, -value)
             .when(rule == 2, F.lit(100000.0) + value)
             .when(rule == 3, F.lit(100000.004))
             .when(rule == 4, F.lit(-0.004))
             .when(rule == 5, F.lit(2e10))
             .when(rule == 6, F.lit(float("nan")))
             .otherwise(value * (3 + 9 * (eid % 4))))

    # Wall-clock micros since the epoch; NTZ arithmetic, so no time zone.
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', time)")
    bucket = F.floor(micros / F.lit(SESSION_SECONDS * 1_000_000)).cast("long")
    session = F.concat(F.lit("u"),
                       F.greatest(uid, F.lit(SHARED_SESSION_UPTO)).cast("string"), F.lit("z"),
                       zone.cast("string"), F.lit("-"), bucket.cast("string"))

    return joined.select(
        unless(NULL_TIME_EVERY, F.col("time")).alias("event_time"),
        mapped_type.alias("event_type"),
        unless(NULL_PRODUCT_EVERY, F.col("k")).alias("product_id"),
        size.cast("long").alias("category_id"),
        code.alias("category_code"),
        F.when(size % 7 == 0, null_string).otherwise(F.col("p_brand")).alias("brand"),
        price.alias("price"),
        unless(NULL_USER_EVERY, F.when(zone == 0, uid).otherwise(
            uid % ZONE_USERS + zone * ZONE_STEP).cast("long")).alias("user_id"),
        unless(NULL_SESSION_EVERY, session).alias("user_session"),
    )


def raw_events_from_dir(spark: SparkSession, data_dir: str) -> DataFrame:
    return raw_events(read_table(spark, data_dir, "events"),
                      read_table(spark, data_dir, "part"))
