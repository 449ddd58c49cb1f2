import datetime as dt
import os
import time

from shoplens.plans.warehouse import run_pipeline
from tests.test_ingest import _csv, _row


def _day_rows(day, users, etype="view"):
    return [_row(f"2024-01-{day:02d} {10 + i:02d}:00:00 UTC", etype=etype, user=u, session=f"s{u}-{day}",
                 code="electronics.phone", price="120.00")
            for i, u in enumerate(users)]


def test_end_to_end_incremental(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    out = os.path.join(tmpdir_path, "out")
    os.makedirs(raw)
    now = time.time()
    _csv(os.path.join(raw, "a.csv"), _day_rows(1, [1, 2, 3]) + _day_rows(2, [1], "purchase"), now - 60)
    r1 = run_pipeline(spark, raw, out)
    assert r1["batches"] == 1
    wh = r1["warehouse"]
    assert wh.fact.count() == 4
    assert not any(isinstance(v, Exception) for v in r1["checks"].values())
    counts = {r.table_name: r.row_count for r in r1["checks"]["row_counts"]}
    assert counts["marts.fact_events"] == 4 and counts["marts.fact_sessions"] == 4

    _csv(os.path.join(raw, "b.csv"), _day_rows(9, [2, 4]) + _day_rows(10, [4], "cart"), now - 30)
    r2 = run_pipeline(spark, raw, out)
    assert r2["batches"] == 1                       # only the new file
    wh = r2["warehouse"]
    assert wh.fact.count() == 7
    ret = {(x.cohort_week, x.week_number): x.active_users for x in wh.retention.collect()}
    assert ret[(dt.date(2024, 1, 1), 0)] == 3      # users 1, 2, 3
    assert ret[(dt.date(2024, 1, 1), 1)] == 1      # user 2 came back in week 1
    assert ret[(dt.date(2024, 1, 8), 0)] == 1      # user 4's cohort

    assert r2["total_rows"] == 7 and [f["file"] for f in r2["files"]] == ["b.csv"]
    assert spark.table("staging.stg_events").count() == 7
    assert spark.table("marts.fact_events").where("event_date = DATE'2024-01-09'").count() == 2
    assert set(r2["names"]) == {"staging.stg_events", "marts.fact_events", "marts.fact_sessions",
                                "marts.mart_funnel_daily", "marts.mart_retention_cohort_weekly",
                                "marts.mart_category_growth_weekly", "marts.mart_rfm",
                                "marts.mart_price_performance", "marts.mart_product_matrix"}
    again = run_pipeline(spark, raw, out, check="date_range")
    assert again["status"] == "no_new_files" and "fact" not in again["seconds"]
    assert again["warehouse"].fact.count() == 7

    r3 = run_pipeline(spark, raw, out, sample_days=2, check="date_range")
    assert r3["batches"] == 0
    (rng,) = r3["checks"]["date_range"]
    assert (rng.min_date, rng.max_date, rng.days) == (dt.date(2024, 1, 1), dt.date(2024, 1, 2), 2)


def test_publish_tables(spark):
    from shoplens.plans.warehouse import Warehouse, publish_tables
    wh = Warehouse(spark, "/root/testdata/sf0.001")
    names = publish_tables(wh, layers=("fact", "funnel", "rfm"), prefix="t_")
    assert names == ["t_marts.fact_events", "t_marts.mart_funnel_daily", "t_marts.mart_rfm"]
    assert spark.table("t_marts.mart_funnel_daily").count() == wh.funnel.count()
    assert spark.table("t_marts.fact_events").count() == wh.fact.count()
    for n in names:
        spark.sql(f"DROP TABLE {n}")


def test_command_line(spark, tmpdir_path, capsys):
    from shoplens.__main__ import main
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    _csv(os.path.join(raw, "a.csv"), _day_rows(1, [1, 2]) + _day_rows(3, [2], "purchase"))
    code = main([raw, os.path.join(tmpdir_path, "out"), "--check", "date_range",
                 "--sample-weeks", "1"])
    out = capsys.readouterr().out
    assert code == 0
    assert '"batches": 1' in out and "-- date_range" in out and "'days': 2" in out
    # The next file comes as a stream, and only its date is rebuilt.
    _csv(os.path.join(raw, "b.csv"), _day_rows(5, [7]))
    code = main([raw, os.path.join(tmpdir_path, "out"), "--check", "date_range",
                 "--sample-weeks", "1", "--stream"])
    out = capsys.readouterr().out
    assert code == 0 and '"rebuilt": "touched"' in out and "'days': 3" in out


def test_no_raw_files(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    r = run_pipeline(spark, raw, os.path.join(tmpdir_path, "out"))
    assert r["files"] == [] and r["status"] == "no_data" and r["batches"] == 0 and r["checks"] == {}


def _names(spark):
    return {t: spark.table(t).count() for t in ("staging.stg_events", "staging.stg_events_model", "marts.fact_events",
                                                "marts.mart_funnel_daily", "marts.mart_rfm")}


def test_a_killed_run_leaves_the_old_tables(spark, tmpdir_path, monkeypatch):
    """A run that dies in the middle changes nothing that readers see; the
    next one publishes all layers together."""
    import pytest

    from shoplens.plans import versions, warehouse
    raw, out = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "out")
    os.makedirs(raw)
    _csv(os.path.join(raw, "a.csv"), _day_rows(1, [1, 2, 3]) + _day_rows(2, [1], "purchase"))
    first = run_pipeline(spark, raw, out, check="date_range")
    before = _names(spark)
    held = spark.table("marts.fact_events")         # a reader that has begun
    assert first["version"] == 1 and before["marts.fact_events"] == 4

    _csv(os.path.join(raw, "b.csv"), _day_rows(9, [2, 4]) + _day_rows(10, [4], "cart"))
    real = warehouse.MaterializedWarehouse.build

    def dies(self, layer):
        if layer == "rfm":
            raise RuntimeError("killed")
        return real(self, layer)
    monkeypatch.setattr(warehouse.MaterializedWarehouse, "build", dies)
    with pytest.raises(RuntimeError, match="killed"):
        run_pipeline(spark, raw, out, check="date_range")
    assert _names(spark) == before and versions.current(spark, out)["version"] == 1
    assert spark.read.parquet(f"{versions.current(spark, out)['path']}/fact").count() == 4

    monkeypatch.undo()
    again = run_pipeline(spark, raw, out, check="date_range", sample_days=99)
    assert again["version"] == 2 and spark.table("marts.fact_events").count() == 7
    assert held.count() == 4                        # its files are still there
    left = sorted(d for d in os.listdir(out) if d.startswith("v"))
    assert [d[:7] for d in left] == ["v000001", "v000002"]
    run_pipeline(spark, raw, out, check="date_range", sample_days=99)
    assert sorted(d[:7] for d in os.listdir(out) if d.startswith("v")) == ["v000002", "v000003"]


def test_staging_model_is_a_lasting_view(spark, tmpdir_path):
    from shoplens.plans.staging import stg_events
    raw, out = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "out")
    os.makedirs(raw)
    _csv(os.path.join(raw, "a.csv"), _day_rows(1, [1, 2, 3]) + _day_rows(7, [1], "purchase"))
    run_pipeline(spark, raw, out, check="date_range", prefix="v_")
    view = spark.newSession().table("v_staging.stg_events_model")
    model = stg_events(spark.table("v_staging.stg_events"))
    assert view.dtypes == model.dtypes
    assert sorted(map(tuple, view.collect())) == sorted(map(tuple, model.collect()))
    assert spark.catalog.getTable("v_staging.stg_events_model").tableType == "VIEW"
