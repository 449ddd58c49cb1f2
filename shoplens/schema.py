"""Schemas and fixed values of the clickstream contract."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
VALID_EVENT_TYPES = ("view", "cart", "purchase")
PRICE_MIN = 0
PRICE_MAX = 100000
PRICE_BUCKETS = ("unknown", "0-10", "10-50", "50-100", "100-500", "500+")
PRICE_BUCKET_EDGES = ((10, "0-10"), (50, "10-50"), (100, "50-100"), (500, "100-500"))
USER_TYPES = ("new", "returning")
FUNNEL_STAGES = (0, 1, 2, 3)  # none, view, cart, purchase
# a time of day followed by a zone
ZONED_TIME = r":\d{2}(\.\d+)?\s*(UTC|Z|[+-]\d{2}(:?\d{2})?)$"
MONEY = T.DecimalType(12, 2)

# CSV edge: explicit types, no inference pass.
RAW_CSV_SCHEMA = T.StructType([
    T.StructField("event_time", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
])

# Columns of the cleaned, date-partitioned event files and the staging table.
CLEAN_COLUMNS = (
    "event_timestamp", "event_date", "event_type", "product_id", "category_id",
    "category_code", "brand", "price", "user_id", "user_session",
)

STAGING_SCHEMA = T.StructType([
    T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", MONEY),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
])
