"""Distinct users from daily sketches against exact counts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shoplens.plans import sketches
from shoplens.session import reliable


@pytest.fixture(scope="module")
def small(spark):
    rng = random.Random(2)
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(days=rng.randrange(70)), rng.choice(["new", "returning"]),
             rng.choice([None, *range(90)])) for _ in range(2500)]
    df = spark.createDataFrame(rows, "event_date date, user_type string, user_id long")
    return rows, reliable(sketches.daily_user_sketches(df))


def users(rows, low, high, kind=None):
    return {u for d, t, u in rows if low <= d <= high and u is not None and kind in (None, t)}


def test_ranges_are_exact_while_small(small):
    rows, daily = small
    for a, b in ((0, 69), (3, 3), (10, 39), (60, 80), (100, 110)):
        low, high = (dt.date(2024, 1, 1) + dt.timedelta(days=x) for x in (a, b))
        got = sketches.active_users(daily, (), low, high).first().active_users
        assert (got or 0) == len(users(rows, low, high))
        by_type = {r.user_type: r.active_users for r in sketches.active_users(daily, ["user_type"], low, high).collect()}
        assert by_type == {k: n for k in ("new", "returning") if (n := len(users(rows, low, high, k)))}


def test_trailing_windows(small):
    rows, daily = small
    got = {r.event_date: (r.active_7d, r.active_30d) for r in sketches.trailing_active(daily).collect()}
    assert got == {d: tuple(len(users(rows, d - dt.timedelta(days=n - 1), d)) for n in (7, 30)) for d, _, _ in rows}


def test_weeks_and_intersections(small):
    rows, daily = small
    week = lambda d: d - dt.timedelta(days=d.weekday())
    got = {r.event_week: (r.new_users, r.returning_users, r.new_and_returned)
           for r in sketches.new_and_returned(daily).collect()}
    want = {}
    for w in {week(d) for d, _, _ in rows}:
        new, old = (users(rows, w, w + dt.timedelta(days=6), k) for k in ("new", "returning"))
        want[w] = (len(new), len(old), len(new & old))
    assert got == want


def test_measured_error(spark):
    """200,000 users over 40 days: days, weeks and 30 days within 3 %."""
    df = spark.range(600_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.hash("id"), F.lit(40))).alias("event_date"),
        F.when(F.col("id") % 3 == 0, "new").otherwise("returning").alias("user_type"),
        F.pmod(F.hash("id", F.lit(9)), F.lit(200_000)).cast("long").alias("user_id"))
    daily = reliable(sketches.daily_user_sketches(df))
    week = F.trunc("event_date", "week").alias("week")
    exact = {r.week: r.n for r in df.groupBy(week).agg(F.count_distinct("user_id").alias("n")).collect()}
    for kind in ("theta", "hll"):
        for r in sketches.active_users(daily, [week], sketch=kind).collect():
            assert abs(r.active_users / exact[r.week] - 1) < 0.03
    month = df.where("event_date BETWEEN DATE'2024-01-05' AND DATE'2024-02-03'")
    n = month.select("user_id").distinct().count()
    for kind in ("theta", "hll"):
        got = sketches.active_users(daily, (), "2024-01-05", "2024-02-03", sketch=kind).first().active_users
        assert abs(got / n - 1) < 0.03
    both = (month.where("user_type = 'new'").select("user_id").distinct()
            .join(month.where("user_type = 'returning'").select("user_id").distinct(), "user_id").count())
    r = sketches.new_and_returned(daily.where("event_date BETWEEN DATE'2024-01-05' AND DATE'2024-02-03'"), F.lit(1), "p").first()
    assert abs(r.new_and_returned / both - 1) < 0.06
