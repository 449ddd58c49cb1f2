import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from shoplens.functions import (category_level, day_of_week, price_bucket, ratio_pct,
                                round_ratio, week_start)


def test_price_bucket_edges(spark):
    prices = [None, "-1", "0", "9.99", "10", "49.99", "50", "99.99", "100", "499.99", "500",
              "100000"]
    df = spark.createDataFrame([(p,) for p in prices], "p string").select(
        "p", price_bucket(F.col("p").cast("decimal(12,2)")).alias("b"))
    got = {r.p: r.b for r in df.collect()}
    assert got[None] == "unknown"
    assert got["-1"] == "0-10" and got["0"] == "0-10" and got["9.99"] == "0-10"
    assert got["10"] == "10-50" and got["49.99"] == "10-50"
    assert got["50"] == "50-100" and got["99.99"] == "50-100"
    assert got["100"] == "100-500" and got["499.99"] == "100-500"
    assert got["500"] == "500+" and got["100000"] == "500+"


def _expected_round(n, d, factor):
    return (Decimal(n) * factor / Decimal(d)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def test_ratio_rounding_is_exact(spark):
    rnd = random.Random(7)
    pairs = [(rnd.randint(-10**7, 10**7), rnd.randint(1, 10**6)) for _ in range(3000)]
    pairs += [(1, 8), (-1, 8), (5, 2000), (-5, 2000), (0, 3), (7, 0), (1, 3), (2, 3)]
    df = spark.createDataFrame(pairs, "n long, d long").select(
        "n", "d", ratio_pct(F.col("n"), F.col("d")).alias("pct"),
        round_ratio(F.col("n"), F.col("d")).alias("r"))
    for row in df.collect():
        if row.d == 0:
            assert row.pct is None and row.r is None
            continue
        # Decimal quantize with a context precise enough (28 digits) is exact here.
        assert row.pct == _expected_round(row.n, row.d, 100), row
        assert row.r == _expected_round(row.n, row.d, 1), row


def test_category_levels(spark):
    codes = [None, "", "a", "a.b", "a.b.c", "a.b.c.d"]
    df = spark.createDataFrame([(c,) for c in codes], "c string").select(
        "c", *[category_level("c", i).alias(f"l{i}") for i in (1, 2, 3)])
    got = {r.c: (r.l1, r.l2, r.l3) for r in df.collect()}
    assert got[None] == (None, None, None)
    assert got[""] == ("", "", "")
    assert got["a"] == ("a", "", "")
    assert got["a.b.c.d"] == ("a", "b", "c")


def test_calendar(spark):
    days = [dt.date(2024, 1, 7), dt.date(2024, 1, 8), dt.date(2024, 1, 31), dt.date(2024, 3, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select(
        "d", day_of_week("d").alias("dow"), week_start("d").alias("wk"))
    got = {r.d: (r.dow, r.wk) for r in df.collect()}
    assert got[dt.date(2024, 1, 7)] == (0, dt.date(2024, 1, 1))    # Sunday -> previous Monday
    assert got[dt.date(2024, 1, 8)] == (1, dt.date(2024, 1, 8))    # Monday starts a week
    assert got[dt.date(2024, 1, 31)] == (3, dt.date(2024, 1, 29))
    assert got[dt.date(2024, 3, 3)] == (0, dt.date(2024, 2, 26))
