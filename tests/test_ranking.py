import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.operators.ranking import add_ntiles, percentile_cont
from shoplens.session import reliable


def _window_ntile(df, keys, k):
    return {r.id: r.t for r in df.select(
        "id", F.ntile(k).over(Window.orderBy(*keys)).alias("t")).collect()}


@pytest.mark.parametrize("n", [1, 3, 5, 7, 11, 60])
def test_ntile_small_sizes(spark, n):
    df = spark.createDataFrame([(i, (i * 7) % 4) for i in range(n)], "id long, key long")
    got = add_ntiles(df, {"t": ["key", "id"]}, 5)
    assert {r.id: r.t for r in got.collect()} == _window_ntile(df, ["key", "id"], 5)


def test_ntile_many_buckets_hot_key(spark):
    rnd = random.Random(3)
    rows = [(i, 0 if rnd.random() < 0.85 else rnd.randint(1, 50), rnd.randint(-5, 5))
            for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, key long, neg long")
    got = add_ntiles(df, {"a": ["key", "id"], "b": ["neg", "id"]}, 5)
    res = {r.id: (r.a, r.b) for r in got.collect()}
    wa = _window_ntile(df, ["key", "id"], 5)
    wb = _window_ntile(df, ["neg", "id"], 5)
    assert res == {i: (wa[i], wb[i]) for i in wa}
    sizes = np.bincount([v[0] for v in res.values()])[1:]
    assert sizes.max() - sizes.min() <= 1


def test_ntile_all_keys_tied(spark):
    df = spark.createDataFrame([(i, 1) for i in range(23)], "id long, key long")
    got = add_ntiles(df, {"t": ["key", "id"]}, 5)
    assert {r.id: r.t for r in got.collect()} == _window_ntile(df, ["key", "id"], 5)


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [3.0, 1.0, 2.0], [1.0, 1.0, 1.0, 9.0], [float(i) for i in range(100)],
    [None, 4.0, 2.0, None, 8.0],
])
def test_percentile_cont(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = percentile_cont(df, "v", 0.5)
    clean = [v for v in values if v is not None]
    assert got == pytest.approx(float(np.percentile(clean, 50)))


def test_percentile_cont_distributed(spark):
    rnd = random.Random(11)
    vals = [float(rnd.choice([0, 0, 0, rnd.randint(1, 1000)])) for _ in range(3001)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for p in (0.1, 0.5, 0.9):
        got = percentile_cont(df, "v", p)
        assert got == pytest.approx(float(np.percentile(vals, p * 100)))


def test_percentile_empty(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert percentile_cont(df, "v", 0.5) is None


def test_wide_keys_need_several_passes(spark, monkeypatch):
    from shoplens.operators import ranking
    monkeypatch.setattr(ranking, "BINS", 8)
    rnd = random.Random(5)
    rows = [(rnd.randrange(-2 ** 63, 2 ** 63), round(rnd.lognormvariate(0, 9), 4)) for _ in range(300)]
    rows += [(2 ** 63 - 1, 1e18), (-2 ** 63, 1e-9)]
    df = spark.createDataFrame(rows, "id long, key double")
    got = ranking.rows_at(df, {"id": (("id",), [0, 7, 150, 301]), "key": (("key", "id"), [0, 99, 301])})
    ids, keys = sorted(r[0] for r in rows), sorted((r[1], r[0]) for r in rows)
    assert [int(v[0]) for v in got["id"]] == [ids[p] for p in (0, 7, 150, 301)]
    assert [(float(v), int(i)) for v, i in got["key"]] == [keys[p] for p in (0, 99, 301)]


def test_no_global_window(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(50)], "id long, key long")
    plan = add_ntiles(df, {"t": ["key", "id"]}, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan and "Exchange" not in plan


def _scans(monkeypatch, run):
    """Passes over the table: aggregating ones and fetches."""
    from shoplens.operators import ranking
    seen = []
    for name in ("_count", "_fetch"):
        real = getattr(ranking, name)
        monkeypatch.setattr(ranking, name, lambda *a, real=real, name=name: (seen.append(name), real(*a))[1])
    return run(), seen


@pytest.mark.parametrize("fetch", [1, 7, 200])
def test_small_pieces_are_reached_by_sketches(spark, monkeypatch, fetch):
    """Without rows to collect, the passes alone settle every position."""
    from shoplens.operators import ranking
    monkeypatch.setattr(ranking, "FETCH", fetch)
    rnd = random.Random(6)
    rows = [(k if k else None, 0 if rnd.random() < 0.6 else rnd.randrange(40), rnd.randrange(10 ** 9),
             Decimal(rnd.randrange(10 ** 7)) / 100 if rnd.random() < 0.7 else Decimal(0), rnd.lognormvariate(0, 30))
            for k in range(3000)]
    df = reliable(spark.createDataFrame(rows, "id long, hot long, wide long, money decimal(22,2), real double"))
    at = [0, 1, 599, 1500, 2400, 2999]
    got = ranking.rows_at(df, {c: ((c, "id"), at) for c in ("hot", "wide", "money", "real")})
    for j, c in enumerate(("hot", "wide", "money", "real"), 1):
        order = sorted(rows, key=lambda r: (r[j], -1 if r[0] is None else r[0]))
        kind = (int, int, Decimal, float)[j - 1]
        assert [(kind(v), None if i is None else int(i)) for v, i in got[c]] == [(order[p][j], order[p][0]) for p in at]


def test_a_pass_scans_once_for_all_searches(spark, monkeypatch):
    from shoplens.operators import ranking
    monkeypatch.setattr(ranking, "FETCH", 50)
    df = reliable(spark.range(0, 30_000, 1, 4).selectExpr(
        "id", "hash(id) a", "if(id % 3 = 0, 5, hash(id, 1) % 9) b", "cast(hash(id, 2) as double) c"))
    for k in (5, 50):
        cuts, seen = _scans(monkeypatch, lambda k=k: ranking.add_ntiles(
            df, {"x": ["a", "id"], "y": ["b", "id"], "z": ["c", "id"]}, k, stored=True))
        assert seen.count("_count") <= 4 and seen.count("_fetch") <= 3, seen
        sizes = {c: sorted(r["count"] for r in cuts.groupBy(c).count().collect()) for c in "xyz"}
        assert all(len(s) == k and s[-1] - s[0] <= 1 for s in sizes.values())


def test_small_tables_need_one_pass_and_one_fetch(spark, monkeypatch):
    df = reliable(spark.range(5000).selectExpr("id", "hash(id) a", "id % 7 b"))
    from shoplens.operators.ranking import add_ntiles as ntiles
    _, seen = _scans(monkeypatch, lambda: ntiles(df, {"x": ["a", "id"], "y": ["b", "id"]}, 5, stored=True))
    assert seen == ["_count", "_fetch"]


def test_null_tie_break_is_the_first_of_its_value(spark):
    df = spark.createDataFrame([(None, 1)] + [(k, 1 if k < 8 else 0) for k in range(-3, 12)], "id long, key long")
    got = {r.id: r.t for r in add_ntiles(df, {"t": ["key", "id"]}, 5).collect()}
    assert got == _window_ntile(df, ["key", F.col("id").asc_nulls_first()], 5)


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, key long")
    assert add_ntiles(df, {"t": ["key", "id"]}, 5).count() == 0
