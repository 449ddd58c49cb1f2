"""Ingest: validate and clean raw events, statistics, samples, sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.schema import (CLEAN_COLUMNS, MONEY, PRICE_MAX, PRICE_MIN,
                             STAGING_SCHEMA, VALID_EVENT_TYPES, ZONED_TIME)


def time_of_text(text: F.Column) -> F.Column:
    """UTC wall clock of a time in text; bad text becomes NULL.

    ISO date and time with a space or ``T``, optional fraction, and an
    optional zone (``UTC``, ``Z``, ``+hh``, ``+hhmm``, ``+hh:mm``); without
    a zone the text is the UTC wall clock already; a date alone is midnight.
    """
    t = F.trim(text)
    zoned = t.rlike(ZONED_TIME)
    # The engine reads a zone written right behind the time.
    joined = F.regexp_replace(F.regexp_replace(t, r"\s+(?=(?:UTC|Z|[+-]\d{2})\S*$)", ""),
                              r"([+-]\d{2})(?::?(\d{2}))?$", "$1:$2")
    exact = F.regexp_replace(joined, r":$", ":00")
    instant = F.convert_timezone(F.current_timezone(), F.lit("UTC"),
                                 exact.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(zoned, instant).otherwise(t.try_cast("timestamp_ntz"))


def parsed_time(raw: DataFrame) -> F.Column:
    """``event_time`` as a UTC wall-clock timestamp; bad text becomes NULL."""
    c = F.col("event_time")
    if isinstance(raw.schema["event_time"].dataType, T.StringType):
        return time_of_text(c)
    return c.cast(T.TimestampNTZType())


def invalid_type_flag(event_type="event_type") -> F.Column:
    """TRUE for a type outside the whitelist.  NULL NOT IN (...) is NULL, so
    a NULL type is *not* flagged (it is dropped later by staging)."""
    return F.when(~F.col(event_type).isin(*VALID_EVENT_TYPES), True).otherwise(False)


def invalid_price_flag(price="price") -> F.Column:
    p = F.col(price)
    return p.isNull() | (p < PRICE_MIN) | (p > PRICE_MAX)


def clean_events(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw contract -> cleaned events (time parsed, date derived, bad price
    nulled, invalid types dropped).  Column order follows the sink; ``keep``
    names extra columns to carry along (e.g. the source file)."""
    # The raw number is judged, and only a valid one becomes money: rounding
    # first would turn 100000.004 valid, and a huge value would not fit.
    price = F.when(~invalid_price_flag(), F.col("price")).cast("double")
    return (raw
            .withColumn("event_timestamp", parsed_time(raw))
            .where(F.col("event_timestamp").isNotNull())
            .where(~invalid_type_flag())
            .select(
                "event_timestamp",
                F.to_date("event_timestamp").alias("event_date"),
                "event_type", "product_id", "category_id", "category_code", "brand",
                price.try_cast(MONEY).alias("price"),
                "user_id", "user_session", *keep))


def ingest_stats(raw: DataFrame) -> DataFrame:
    """One-pass statistics of a raw batch: totals over the unfiltered rows,
    plus the rows and dates the clean step keeps."""
    ts = parsed_time(raw)
    kept = ts.isNotNull() & ~invalid_type_flag()
    return raw.select(ts.alias("_ts"), kept.alias("_kept"), "event_type", "price").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("event_type").isin(*VALID_EVENT_TYPES) == F.lit(False))
         .alias("invalid_event_types"),
        F.count_if(invalid_price_flag()).alias("invalid_prices"),
        F.min("_ts").alias("min_time"),
        F.max("_ts").alias("max_time"),
        F.count_if("_kept").alias("processed_rows"),
        F.count_distinct(F.when(F.col("_kept"), F.to_date("_ts"))).alias("partitions"),
    )


def sample_first_weeks(clean: DataFrame, weeks: int) -> DataFrame:
    """Keep ``event_date <= min(event_date) + 7*weeks`` (inclusive, so 7N+1
    calendar days).  The minimum is a scalar subquery, computed once."""
    if not weeks:
        return clean
    first = clean.agg(F.min("event_date")).scalar()
    return clean.where(F.col("event_date") <= F.date_add(first, 7 * weeks))


def first_partitions(events: DataFrame, days: int | None) -> DataFrame:
    """Keep the first ``days`` event-date partitions (present dates, not
    calendar days).  The last of these dates is a scalar subquery, so a
    date-partitioned scan reads only those folders, and nothing runs while
    the plan is built."""
    if not days:
        return events
    last = (events.select("event_date").distinct().orderBy("event_date").limit(days)
            .agg(F.max("event_date")).scalar())
    return events.where(F.col("event_date") <= last)


def staging_frame(events: DataFrame) -> DataFrame:
    """Cast to the typed staging layout."""
    return events.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                           for f in STAGING_SCHEMA.fields])


def load_summary(staging: DataFrame) -> DataFrame:
    """Rows, distinct users and products, date range.  Each distinct count
    is its own distinct-then-count (a scalar subquery), so no input row is
    expanded once per distinct column."""
    def distinct_of(c):
        return staging.select(c).distinct().agg(F.count(c)).scalar()
    return staging.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("event_date").alias("min_date"),
        F.max("event_date").alias("max_date")).select(
            "total_rows", distinct_of("user_id").alias("unique_users"),
            distinct_of("product_id").alias("unique_products"), "min_date", "max_date")


def write_partitioned(df: DataFrame, path: str, max_records_per_file: int = 5_000_000,
                      partition_cols: tuple[str, ...] = ("event_date",)) -> None:
    """Date-partitioned, ZSTD Parquet (``event_date=YYYY-MM-DD`` folders).
    A date present in this batch replaces that date's folder (dynamic
    overwrite); other dates are untouched.

    Rows are rebalanced by the folder columns: adaptive execution splits a
    large date over several tasks and merges small ones, so the number of
    files follows the data size, not tasks x dates.  Sorting by (date, user)
    inside tasks gives tight row-group statistics on ``user_id``.
    """
    (df.hint("rebalance", *partition_cols)
     .sortWithinPartitions(*partition_cols, *[c for c in ("user_id",) if c in df.columns])
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*partition_cols)
     .parquet(path))


def read_partitioned(spark, path: str) -> DataFrame:
    """Read the date-partitioned files back in contract column order; a
    filter on ``event_date`` prunes folders."""
    return spark.read.parquet(path).select(*CLEAN_COLUMNS)


def write_staging_jdbc(staging: DataFrame, url: str, table: str, properties: dict) -> None:
    """Optional: the same typed staging frame into an external database
    (full replace), written in parallel by the executors."""
    staging_frame(staging).write.jdbc(url, table, mode="overwrite", properties=properties)


def write_staging_table(staging: DataFrame, table: str) -> None:
    """Full replace of the staging table each run."""
    (staging_frame(staging)
     .hint("rebalance", "event_date")
     .sortWithinPartitions("event_date", "user_id")
     .write.mode("overwrite").format("parquet").partitionBy("event_date")
     .saveAsTable(table))
