"""Rebuilding the touched dates gives the rows of a full rebuild."""

import datetime as dt
import os
import random
from collections import Counter

import pytest

from shoplens.plans import refresh, versions, warehouse
from shoplens.plans.warehouse import CsvPipeline, run_pipeline
from tests.test_ingest import _csv, _row

DAYS = 12


def _file(rnd, path, days, rows):
    """Events of some dates; few users and sessions, so that first dates move,
    sessions span dates and are shared, and ids are missing."""
    _csv(path, [_row(f"2024-01-{rnd.choice(days):02d} {rnd.randrange(24):02d}:{rnd.randrange(60):02d}:00 UTC",
                     etype=rnd.choice(["view", "view", "cart", "purchase", None, "other"]),
                     user=rnd.choice([None, *range(1, 12)]), session=rnd.choice([None, *"abcdefghijkl"]),
                     price=rnd.choice(["5.00", "75.5", "-1"]), code=rnd.choice(["x.y", "z.w.v", None]))
                for _ in range(rows)])


def _same(spark, raw, out, wh, layers):
    """Every layer of the version equals that layer derived from all events."""
    whole = CsvPipeline(spark, raw, out)
    for layer in layers:
        got, want = getattr(wh, layer), getattr(whole, layer)
        assert got.columns == want.columns
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())), layer


@pytest.mark.parametrize("seed,mode", [(1, "replace"), (2, "per_file")])
def test_touched_dates_equal_a_full_rebuild(spark, tmpdir_path, monkeypatch, seed, mode):
    monkeypatch.setattr(warehouse, "MART_LAYERS", ("sessions", "funnel", "retention"))
    monkeypatch.setattr(refresh, "MAX_SHARE", 1.0)
    rnd = random.Random(seed)
    raw, out = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "out")
    os.makedirs(raw)
    _file(rnd, os.path.join(raw, "m.csv"), range(1, DAYS + 1), 150)
    assert run_pipeline(spark, raw, out, check="date_range", publish=False, mode=mode)["rebuilt"] == "all"
    names = [f"{c}.csv" for c in "akz"]
    rnd.shuffle(names)
    for k, name in enumerate(names):
        days = [1, 2] if k == 0 else sorted(rnd.sample(range(1, DAYS + 3), rnd.randint(1, 3)))
        _file(rnd, os.path.join(raw, name), days, rnd.randint(2, 9))
        r = run_pipeline(spark, raw, out, check="date_range", publish=k == 2, prefix=f"rf{seed}_", mode=mode)
        assert r["rebuilt"] == "touched" and len(r["warehouse"].parts["fact"]) == k + 2
        assert r["tables"]["fact"] is None and r["tables"]["retention"].endswith("/retention")
    _same(spark, raw, out, r["warehouse"], ("clean", "fact", "sessions", "funnel", "retention"))
    view = spark.newSession().table(f"rf{seed}_marts.fact_sessions")
    assert Counter(map(tuple, view.collect())) == Counter(map(tuple, r["warehouse"].sessions.collect()))
    # All parts of the versions that stay are kept, and a rerun reads them.
    again = run_pipeline(spark, raw, out, check="date_range", publish=False, mode=mode)
    assert (again["rebuilt"], again["version"]) == ("nothing", r["version"])
    assert again["warehouse"].fact.count() == r["warehouse"].fact.count()


def test_untouched_dates_are_not_written_and_parts_are_bounded(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(warehouse, "MART_LAYERS", ("sessions", "funnel"))
    monkeypatch.setattr(refresh, "MAX_PARTS", 2)
    raw, out = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "out")
    os.makedirs(raw)
    _csv(os.path.join(raw, "a.csv"), [_row(f"2024-01-{d:02d} 10:00:00 UTC", user=d, session=f"s{d}")
                                      for d in range(1, 11)])
    run_pipeline(spark, raw, out, check="date_range", publish=False)
    _csv(os.path.join(raw, "b.csv"), [_row("2024-01-12 10:00:00 UTC", user=99, session="t")])
    second = run_pipeline(spark, raw, out, check="date_range", publish=False)
    folder = versions.current(spark, out)["path"]
    for layer in ("clean", "fact", "funnel", "sessions"):
        assert [d for d in os.listdir(f"{folder}/{layer}") if "=" in d] == [
            f"{refresh.DATED[layer]}=2024-01-12"]
    # An earlier event of user 10 moves the first date: its later date is tagged anew.
    assert second["rebuilt"] == "touched"
    _csv(os.path.join(raw, "c.csv"), [_row("2023-12-31 10:00:00 UTC", user=10, session="u")])
    third = run_pipeline(spark, raw, out, check="date_range", publish=False)
    assert third["rebuilt"] == "all"            # two parts are the bound here
    assert [p.dates for p in third["warehouse"].parts.get("fact", [])] in ([], [None])
    _csv(os.path.join(raw, "d.csv"), [_row("2023-12-30 10:00:00 UTC", user=7, session="v")])
    fourth = run_pipeline(spark, raw, out, check="date_range", publish=False)
    assert fourth["warehouse"].parts["fact"][-1].dates == (dt.date(2023, 12, 30), dt.date(2024, 1, 7))
    assert fourth["warehouse"].parts["clean"][-1].dates == (dt.date(2023, 12, 30),)
    _same(spark, raw, out, fourth["warehouse"], ("clean", "fact", "sessions", "funnel"))


def test_files_of_an_unpublished_run_are_made_up_for(spark, tmpdir_path, monkeypatch):
    """A run that dies between ingest and publication leaves files that the
    ledger knows and no version holds."""
    monkeypatch.setattr(warehouse, "MART_LAYERS", ("sessions", "funnel"))
    raw, out = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "out")
    os.makedirs(raw)
    _csv(os.path.join(raw, "a.csv"), [_row(f"2024-01-{d:02d} 10:00:00 UTC", user=d) for d in range(1, 9)])
    run_pipeline(spark, raw, out, check="date_range", publish=False)
    _csv(os.path.join(raw, "b.csv"), [_row("2024-01-20 10:00:00 UTC", user=3)])

    def dies(*args):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(warehouse.CsvPipeline, "refresh", dies)
        with pytest.raises(RuntimeError, match="killed"):
            run_pipeline(spark, raw, out, check="date_range", publish=False)
    r = run_pipeline(spark, raw, out, check="date_range", publish=False)
    assert r["status"] == "no_new_files" and r["rebuilt"] == "touched"
    assert r["warehouse"].fact.count() == 9
    # A sampled version is not taken for the whole one.
    run_pipeline(spark, raw, out, check="date_range", publish=False, sample_days=2)
    back = run_pipeline(spark, raw, out, check="date_range", publish=False)
    assert back["rebuilt"] == "all" and back["warehouse"].fact.count() == 9
