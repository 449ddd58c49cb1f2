import datetime as dt
from decimal import Decimal

import pytest

from shoplens.plans import facts, marts
from shoplens.plans.staging import stg_events
from shoplens.schema import STAGING_SCHEMA


def T(day, hour=0, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def events(spark, rows):
    """rows: (ts, type, product, code, price, user, session)"""
    data = [(ts, ts.date(), et, prod, 1, code, "b", None if p is None else Decimal(p), u, s)
            for ts, et, prod, code, p, u, s in rows]
    return stg_events(spark.createDataFrame(data, STAGING_SCHEMA))


@pytest.fixture()
def fact(spark):
    rows = [
        # user 1: session crossing midnight, view -> cart -> purchase on two products
        (T(1, 23, 50), "view", 10, "a.x", "5.00", 1, "s1"),
        (T(2, 0, 5), "cart", 11, "a.x", "60.00", 1, "s1"),
        (T(2, 0, 10), "purchase", 11, "a.x", "60.00", 1, "s1"),
        # user 2 shares session id s1; purchase without view or cart, NULL price
        (T(2, 1), "purchase", 12, "b.y", None, 2, "s1"),
        # user 3: several events on the first day, then next week with a gap week after
        (T(1, 9), "view", 10, "a.x", "5.00", 3, "s3"),
        (T(1, 10), "view", 10, "a.x", "5.00", 3, "s3"),
        (T(8, 10), "view", 10, "", "500.00", 3, "s4"),
        (T(22, 10), "purchase", 10, None, "500.00", 3, "s5"),
    ]
    return facts.fact_events(events(spark, rows))


def test_fact_events_user_type_and_revenue(fact):
    rows = {(r.user_id, r.event_timestamp): r for r in fact.collect()}
    assert rows[(3, T(1, 9))].user_type == "new" and rows[(3, T(1, 10))].user_type == "new"
    assert rows[(3, T(8, 10))].user_type == "returning"
    assert rows[(2, T(2, 1))].revenue == Decimal("0.00")           # NULL price purchase
    assert rows[(2, T(2, 1))].price_bucket == "unknown"
    assert rows[(3, T(22, 10))].price_bucket == "500+"
    assert rows[(1, T(1, 23, 50))].day_of_week == 1                # Monday
    assert rows[(3, T(8, 10))].category_l1 == ""


def test_fact_sessions(fact):
    s = {(r.user_session, r.user_id): r for r in facts.fact_sessions(fact).collect()}
    a = s[("s1", 1)]
    assert a.session_date == dt.date(2024, 1, 1)                    # crosses midnight
    assert a.session_duration_minutes == pytest.approx(20.0)
    assert (a.total_events, a.products_viewed, a.max_funnel_stage) == (3, 2, 3)
    assert a.view_to_cart_rate == 1.0 and a.cart_to_purchase_rate == 1.0
    b = s[("s1", 2)]                                                # shared id: own row
    assert b.has_purchase and not b.has_cart and b.cart_to_purchase_rate == 0.0


def test_funnel_zero_denominators(fact):
    rows = marts.funnel_daily(fact).collect()
    purchase_only = [r for r in rows if r.view_users == 0 and r.purchase_users > 0]
    assert purchase_only and all(r.cart_rate_pct == 0 and r.purchase_rate_pct == 0
                                 for r in purchase_only)


def test_retention(fact):
    r = {(x.cohort_week, x.week_number): x for x in marts.retention_cohort_weekly(fact).collect()}
    c = dt.date(2024, 1, 1)
    assert r[(c, 0)].cohort_size == 3 and r[(c, 0)].retention_rate_pct == Decimal("100.00")
    assert r[(c, 1)].active_users == 1 and r[(c, 1)].week_label == "Week 1"
    assert (c, 2) not in r                                          # no zero rows
    assert r[(c, 3)].retention_rate_pct == Decimal("33.33")
    assert r[(c, 0)].week_label == "Week 0 (Cohort)"


def test_growth_lag_skips_missing_week(spark):
    rows = [
        (T(1), "purchase", 1, "a.x", "10.00", 1, "s"),
        (T(2), "purchase", 1, "z.x", "0.00", 2, "s"),
        (T(15), "purchase", 1, "a.x", "30.00", 1, "s"),             # week of Jan 8 missing
        (T(15), "purchase", 1, "z.x", "5.00", 2, "s"),
    ]
    g = {(r.event_week, r.category_l1): r for r in
         marts.category_growth_weekly(facts.fact_events(events(spark, rows))).collect()}
    a = g[(dt.date(2024, 1, 15), "a")]
    assert a.revenue_wow_growth_pct == Decimal("200.00")           # vs Jan 1, the last present week
    assert a.revenue_delta == Decimal("20.00")
    z = g[(dt.date(2024, 1, 15), "z")]
    assert z.revenue_wow_growth_pct is None                         # previous revenue 0
    assert g[(dt.date(2024, 1, 1), "a")].revenue_wow_growth_pct is None
    assert g[(dt.date(2024, 1, 1), "a")].revenue_delta == Decimal("10.00")
    assert a.revenue_share_pct == Decimal("85.71") and a.aov == Decimal("30.00")


def test_product_matrix_noise_filter_and_medians(spark):
    rows = []
    for prod, views in ((1, 10), (2, 11), (3, 12), (4, 1)):
        rows += [(T(1, 1, i), "view", prod, "a.x", "1.00", prod * 100 + i, "s") for i in range(views)]
    rows += [(T(2), "purchase", 3, "a.x", "50.00", 1, "s"), (T(2), "purchase", 2, "a.x", None, 1, "s")]
    m = {r.product_id: r for r in marts.product_matrix(facts.fact_events(events(spark, rows))).collect()}
    assert set(m) == {2, 3}                                         # 10 views is noise
    # medians over all 4 products: views 10.5 -> 11 and 12 are high; revenue median 0
    assert m[3].matrix_quadrant == "Star (High View, High Rev)"
    assert m[2].matrix_quadrant == "Problem Child (High View, Low Rev)"
    assert m[2].avg_price is None or m[2].avg_price == Decimal("0.00")
    assert m[3].conversion_rate == Decimal("8.33") and m[2].brand == "b"


def test_rfm_segments_small(spark):
    rows = [(T(d), "purchase" if u % 2 else "view", 1, "a.x", f"{u}.00", u, f"s{u}-{d}")
            for u in range(1, 8) for d in range(1, 1 + u)]
    r = marts.rfm(facts.fact_events(events(spark, rows))).collect()
    assert len(r) == 7
    assert all(1 <= x.r_score <= 5 and x.rfm_score == f"{x.r_score}{x.f_score}{x.m_score}"
               for x in r)
    by = {x.user_id: x for x in r}
    assert by[7].frequency == 7 and by[7].monetary == Decimal("49.00")
    assert by[2].frequency == 0 and by[2].monetary == Decimal("0.00")
    assert by[7].rfm_segment == "Champions"


def test_validation_runner_isolates_checks(spark):
    from shoplens.plans import checks
    from shoplens.plans.warehouse import Warehouse
    wh = Warehouse(spark, "/root/testdata/sf0.001")
    one = checks.validate(wh, "date_range")
    assert list(one) == ["date_range"] and len(one["date_range"]) == 1
    everything = checks.validate(wh)
    assert set(everything) == set(checks.VALIDATIONS)
    assert not any(isinstance(v, Exception) for v in everything.values())


def test_dq_failure_semantics(spark):
    from shoplens.operators.quality import Rule, dq_report
    df = spark.createDataFrame(
        [("a", 1), ("x", 1), ("x", 2), ("y", None), (None, 3), (None, 3)], "v string, k int")
    rep = dq_report({"t": df}, {"t": [Rule("v", "not_null"), Rule("k", "not_null"),
                                      Rule("v", "accepted_values", ("a", "b")),
                                      Rule("k", "unique")]})
    got = {(r.column_name, r.test_name): r.failures for r in rep.collect()}
    assert got == {("v", "not_null"): 2, ("k", "not_null"): 1,
                   ("v", "accepted_values"): 2,          # distinct unexpected values x, y
                   ("k", "unique"): 2}                   # repeated values 1 and 3


def test_rfm_with_null_user(spark):
    rows = [(T(d), "purchase", 1, "a.x", "3.00", u, f"s{u}{d}") for u in (1, 2, 3) for d in (1, u)]
    rows += [(T(2), "view", 1, "a.x", "3.00", None, "sx")]
    r = marts.rfm(facts.fact_events(events(spark, rows))).collect()
    assert len(r) == 4
    assert sorted(x.f_score for x in r) == [1, 2, 3, 4]
    assert [x.f_score for x in r if x.user_id is None] == [1]     # frequency 0, sorts first


def test_retention_over_many_weeks(spark):
    """Years of weeks take several words of bits a user; against counting."""
    import random
    rng = random.Random(4)
    start = dt.datetime(1969, 6, 4)
    rows = []
    for user in [*range(40), None]:
        first = rng.randrange(900)
        for _ in range(rng.randrange(1, 60)):
            at = start + dt.timedelta(days=first + (rng.randrange(1500) if user != 3 else 0))
            rows.append((at, "view", 1, "a.b", "1.00", user, "s"))
    got = {(r.cohort_week, r.week_number): (r.active_users, r.cohort_size, float(r.retention_rate_pct), r.week_label)
           for r in marts.retention_cohort_weekly(facts.fact_events(events(spark, rows))).collect()}

    def monday(day):
        return day - dt.timedelta(days=day.weekday())
    weeks = {}
    for at, *_, user, _ in rows:
        if user is not None:
            weeks.setdefault(user, set()).add(monday(at.date()))
    active = {}
    for user, own in weeks.items():
        for w in own:
            active.setdefault((min(own), (w - min(own)).days // 7), set()).add(user)
    assert max(n for _, n in active) > 128
    want = {}
    for (cohort, n), users in active.items():
        size = len(active[cohort, 0])
        rate = (Decimal(len(users)) * 100 / size).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
        want[cohort, n] = (len(users), size, float(rate), f"Week {n}" if n else "Week 0 (Cohort)")
    assert got == want


def test_week_bits_are_one_row_per_user_and_word(spark):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=k % 60), "view", 1, "a.b", "1.00", 7, "s") for k in range(300)]
    bits = marts.user_week_bits(facts.fact_events(events(spark, rows))).collect()
    assert 1 <= len(bits) <= 2 and sum(bin(r.weeks & (2 ** 64 - 1)).count("1") for r in bits) == 9


def test_growth_counts_distinct_users_and_products(spark):
    import random
    rng = random.Random(8)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randrange(30)), rng.choice(["view", "cart", "purchase"]),
             rng.choice([None, *range(6)]), rng.choice(["a.x", "b.y", "", None]), rng.choice([None, "2.00"]),
             rng.choice([None, *range(5)]), "s") for _ in range(400)]
    fact = facts.fact_events(events(spark, rows))
    got = {(r.event_week, r.category_l1): (r.unique_users, r.view_users, r.cart_users, r.purchasers, r.unique_products,
                                           r.purchase_count, float(r.revenue))
           for r in marts.category_growth_weekly(fact).collect()}
    want = {}
    for at, kind, product, code, price, user, _ in rows:
        if code:
            week = at.date() - dt.timedelta(days=at.weekday())
            own = want.setdefault((week, code[0]), [set(), set(), set(), set(), set(), 0, 0.0])
            if user is not None:
                own[0].add(user)
                own[1 + ["view", "cart", "purchase"].index(kind)].add(user)
            if product is not None:
                own[4].add(product)
            own[5] += kind == "purchase"
            own[6] += float(price or 0) * (kind == "purchase")
    assert got == {k: (*map(len, v[:5]), *v[5:]) for k, v in want.items()}


def test_all_rules_of_a_table_read_it_once(spark, tmpdir_path):
    from shoplens.operators.quality import Rule, table_report
    spark.range(100).selectExpr("id k", "if(id % 7 = 0, null, id % 5) v").write.parquet(tmpdir_path + "/t")
    df = spark.read.parquet(tmpdir_path + "/t")
    rep = table_report("t", df, [Rule("v", "not_null"), Rule("k", "unique"), Rule("v", "unique"),
                                 Rule("v", "accepted_values", (0, 1)), Rule("k", "accepted_values", range(50))])
    got = {(r.column_name, r.test_name): r.failures for r in rep.collect()}
    assert got == {("v", "not_null"): 15, ("k", "unique"): 0, ("v", "unique"): 5,
                   ("v", "accepted_values"): 3, ("k", "accepted_values"): 50}
    assert rep._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan") == 1
