import datetime as dt
import os
import time

import pytest

from shoplens.plans import ingest
from shoplens.plans.staging import stg_events
from shoplens.sources.raw_csv import list_raw_files, read_raw_csv
from shoplens.streaming.incremental import ingest_log, run_incremental_ingest

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"


def _csv(path, rows, mtime=None):
    with open(path, "w") as f:
        f.write(HEADER)
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def _row(ts, etype="view", price="10.5", user=1, session="s1", code="a.b"):
    return (ts, etype, 7, 99, code, "brandx", price, user, session)


def test_discovery(spark, tmpdir_path):
    assert list_raw_files(spark, os.path.join(tmpdir_path, "missing")).count() == 0
    for n in ("b.csv", "a.csv", "notes.txt"):
        with open(os.path.join(tmpdir_path, n), "w") as f:
            f.write(HEADER)
    assert sorted(r.name for r in list_raw_files(spark, tmpdir_path).collect()) == ["a.csv", "b.csv"]


def _run(spark, tmp, **kw):
    return run_incremental_ingest(spark, os.path.join(tmp, "raw"), os.path.join(tmp, "processed"),
                                  os.path.join(tmp, "ckpt"), **kw)


def _rows(spark, tmp):
    return sorted(map(tuple, ingest.read_partitioned(spark, os.path.join(tmp, "processed")).collect()))


def test_clean_rules_and_stats(spark, tmpdir_path):
    rows = [
        _row("2019-10-01 00:00:00 UTC"),
        _row("not a time"),                                   # dropped: bad time
        _row("2019-10-01 10:00:00 UTC", etype="remove_from_cart"),  # dropped: invalid type
        _row("2019-10-01 11:00:00 UTC", etype=None),          # kept by ingest, dropped by staging
        _row("2019-10-02 00:00:00 UTC", price="-1"),          # price nulled
        _row("2019-10-02 00:00:01 UTC", price="0"),
        _row("2019-10-02 00:00:02 UTC", price="100000"),
        _row("2019-10-02 00:00:03 UTC", price="100000.01"),   # price nulled
        _row("2019-10-02 00:00:04 UTC", price=None),
    ]
    path = os.path.join(tmpdir_path, "f.csv")
    _csv(path, rows)
    raw = read_raw_csv(spark, path)
    clean = ingest.clean_events(raw)
    got = clean.orderBy("event_timestamp").collect()
    assert len(got) == 7
    assert got[0].event_timestamp == dt.datetime(2019, 10, 1, 0, 0)
    prices = {r.event_timestamp.second: r.price for r in got if r.event_date == dt.date(2019, 10, 2)}
    assert prices[0] is None and prices[3] is None and prices[4] is None
    assert float(prices[1]) == 0.0 and float(prices[2]) == 100000.0
    assert stg_events(clean).count() == 6
    s = ingest.ingest_stats(raw).first()
    assert s.total_rows == 9 and s.invalid_event_types == 1
    assert s.invalid_prices == 3 and s.processed_rows == 7 and s.partitions == 2


def test_sample_weeks_inclusive(spark):
    base = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(base + dt.timedelta(days=i),) for i in range(20)], "event_date date")
    kept = ingest.sample_first_weeks(df, 1).collect()
    assert max(r.event_date for r in kept) == base + dt.timedelta(days=7)
    assert len(kept) == 8


def test_first_partitions(spark):
    dates = [dt.date(2024, 1, d) for d in (5, 1, 9, 1, 3)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(dates)], "event_date date, x int")
    kept = ingest.first_partitions(df, 2).collect()
    assert sorted(r.x for r in kept) == [1, 3, 4]


def test_partitioned_sink_replaces_only_rewritten_dates(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "events")
    f1 = os.path.join(tmpdir_path, "f1.csv")
    _csv(f1, [_row("2024-01-01 01:00:00 UTC", user=1), _row("2024-01-02 01:00:00 UTC", user=1)])
    ingest.write_partitioned(ingest.clean_events(read_raw_csv(spark, f1)), out)
    f2 = os.path.join(tmpdir_path, "f2.csv")
    _csv(f2, [_row("2024-01-02 05:00:00 UTC", user=2), _row("2024-01-03 05:00:00 UTC", user=2)])
    ingest.write_partitioned(ingest.clean_events(read_raw_csv(spark, f2)), out)
    back = ingest.read_partitioned(spark, out)
    got = sorted((r.event_date.day, r.user_id) for r in back.collect())
    # 2024-01-02 of the first file is replaced by the second file's rows.
    assert got == [(1, 1), (2, 2), (3, 2)]
    assert sorted(d for d in os.listdir(out) if d.startswith("event_date=")) == [
        "event_date=2024-01-01", "event_date=2024-01-02", "event_date=2024-01-03"]


def test_incremental_ingest(spark, tmpdir_path):
    raw_dir = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw_dir)
    now = time.time()
    _csv(os.path.join(raw_dir, "2019-Oct.csv"),
         [_row("2024-01-01 01:00:00 UTC"), _row("2024-01-02 01:00:00 UTC", price="-5")], now - 300)
    _csv(os.path.join(raw_dir, "2019-Nov.csv"), [_row("2024-01-05 01:00:00 UTC", user=3)], now - 200)

    first = _run(spark, tmpdir_path)
    assert first["batches"] == 2 and first["status"] == "success" and first["total_rows"] == 3
    assert [f["file"] for f in first["files"]] == ["2019-Nov.csv", "2019-Oct.csv"]     # by name
    assert first["files"][1]["invalid_prices"] == 1 and first["files"][1]["partitions"] == 2
    assert len(_rows(spark, tmpdir_path)) == 3
    again = _run(spark, tmpdir_path)
    assert (again["status"], again["batches"], again["files"]) == ("no_new_files", 0, [])
    assert again["total_rows"] == 3

    _csv(os.path.join(raw_dir, "2019-Dec.csv"), [_row("2024-01-09 01:00:00 UTC", user=4)], now - 100)
    third = _run(spark, tmpdir_path)
    assert [f["file"] for f in third["files"]] == ["2019-Dec.csv"] and third["total_rows"] == 4
    before = _rows(spark, tmpdir_path)
    refreshed = _run(spark, tmpdir_path, full_refresh=True)
    assert refreshed["batches"] == 3 and refreshed["total_rows"] == 4
    assert _rows(spark, tmpdir_path) == before                              # idempotent
    log = ingest_log(spark, os.path.join(tmpdir_path, "ckpt"))
    assert log.count() == 6 and log.where("generation = 2").count() == 3


def test_an_old_file_that_arrives_late_is_new(spark, tmpdir_path):
    raw_dir = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw_dir)
    _csv(os.path.join(raw_dir, "new.csv"), [_row("2024-02-01 01:00:00 UTC")])
    assert _run(spark, tmpdir_path)["batches"] == 1
    _csv(os.path.join(raw_dir, "old.csv"), [_row("2024-01-01 01:00:00 UTC")], time.time() - 30 * 86400)
    assert [f["file"] for f in _run(spark, tmpdir_path)["files"]] == ["old.csv"]
    assert len(_rows(spark, tmpdir_path)) == 2


def test_many_files_are_all_counted(spark, tmpdir_path):
    raw_dir = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw_dir)
    for k in range(105):
        _csv(os.path.join(raw_dir, f"{k:03d}.csv"), [_row(f"2024-01-{k % 28 + 1:02d} 01:00:00 UTC", user=k)])
    r = _run(spark, tmpdir_path, files_per_batch=35, mode="per_file")
    assert len(r["files"]) == 105 and r["batches"] == 3 and r["total_rows"] == 105
    assert len(_rows(spark, tmpdir_path)) == 105


def test_batch_size_does_not_change_the_rows(spark, tmpdir_path):
    results = []
    for n in (1, 2, 3):
        tmp = os.path.join(tmpdir_path, str(n))
        os.makedirs(os.path.join(tmp, "raw"))
        for name, days in (("a", (1, 2)), ("b", (2, 3)), ("c", (3, 4))):
            _csv(os.path.join(tmp, "raw", f"{name}.csv"),
                 [_row(f"2024-01-{d:02d} 0{k}:00:00 UTC", user=ord(name)) for d in days for k in range(2)])
        r = _run(spark, tmp, files_per_batch=n)
        results.append((_rows(spark, tmp), [{k: v for k, v in f.items()} for f in r["files"]]))
    assert results[0] == results[1] == results[2]
    assert [(x[1].day, x[8]) for x in results[0][0]] == [
        (1, 97)] * 2 + [(2, 98)] * 2 + [(3, 99)] * 2 + [(4, 99)] * 2


def test_folders_may_be_uris(spark, tmpdir_path):
    raw_dir = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw_dir)
    _csv(os.path.join(raw_dir, "a.csv"), [_row("2024-01-01 01:00:00 UTC")])
    here = set(os.listdir("."))
    r = run_incremental_ingest(spark, f"file://{raw_dir}", f"file://{tmpdir_path}/processed",
                               f"file://{tmpdir_path}/ckpt")
    assert r["batches"] == 1 and set(os.listdir(".")) == here
    assert len(_rows(spark, tmpdir_path)) == 1


def test_header_order_and_bad_values(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "f.csv")
    with open(path, "w") as f:
        f.write("user_id,extra,price,event_time,Event_Type,product_id,category_id,category_code,brand,user_session\n")
        f.write("7,x,100000.004,2024-01-01 00:00:00 UTC,view,1,2,a.b,q,s\n")
        f.write("8,x,-0.004,2024-01-01T00:00:01Z,cart,1,2,a.b,q,s\n")
        f.write("9,x,20000000000,2024-01-01 00:00:02.5 UTC,purchase,1,2,a.b,q,s\n")
        f.write("10,x,NaN,2024-01-01 02:00:03+02,purchase,1,2,a.b,q,s\n")
        f.write("eleven,x,5.005,2024-01-01,view,1,2,a.b,q,s\n")
        f.write("12,x,5,yesterday,view,1,2,a.b,q,s\n")
    raw = read_raw_csv(spark, path)
    got = sorted(ingest.clean_events(raw).collect(), key=lambda r: (r.user_id or 0, r.event_timestamp))
    assert [(r.user_id, r.event_timestamp.second, None if r.price is None else float(r.price)) for r in got] == [
        (None, 0, 5.01), (7, 0, None), (8, 1, None), (9, 2, None), (10, 3, None)]
    assert {r.event_timestamp.date() for r in got} == {dt.date(2024, 1, 1)}
    s = ingest.ingest_stats(raw).first()
    assert s.invalid_prices == 4 and s.total_rows == 6 and s.processed_rows == 5
    assert raw.where("unparsed").count() == 2
    with open(path, "w") as f:
        f.write("event_time,price\n")
    with pytest.raises(ValueError, match="user_session"):
        read_raw_csv(spark, path)


def test_files_follow_the_data_not_the_tasks(spark, tmpdir_path):
    rows = [(dt.datetime(2024, 1, d, h), "view", 1, 1, "a.b", "x", 1.0, d * h, "s")
            for d in range(1, 29) for h in range(20)]
    raw = spark.createDataFrame(rows, "event_time timestamp_ntz, event_type string, product_id long, "
                                "category_id long, category_code string, brand string, price double, "
                                "user_id long, user_session string").repartition(8)
    out = os.path.join(tmpdir_path, "ev")
    ingest.write_partitioned(ingest.clean_events(raw), out)
    files = [f for _, _, names in os.walk(out) for f in names if f.endswith(".parquet")]
    assert len(files) == 28


def test_incremental_per_file_mode_is_lossless(spark, tmpdir_path):
    raw_dir = os.path.join(tmpdir_path, "raw")
    out = os.path.join(tmpdir_path, "processed")
    os.makedirs(raw_dir)
    now = time.time()
    _csv(os.path.join(raw_dir, "a.csv"), [_row("2024-01-02 01:00:00 UTC", user=1)], now - 20)
    _csv(os.path.join(raw_dir, "b.csv"), [_row("2024-01-02 09:00:00 UTC", user=2)], now - 10)
    run_incremental_ingest(spark, raw_dir, out, os.path.join(tmpdir_path, "ck"), mode="per_file")
    assert ingest.read_partitioned(spark, out).count() == 2


def test_sample_weeks_per_file(spark, tmpdir_path):
    raw_dir = os.path.join(tmpdir_path, "raw")
    out = os.path.join(tmpdir_path, "processed")
    os.makedirs(raw_dir)
    rows = [_row(f"2024-01-{d:02d} 01:00:00 UTC") for d in range(1, 20)]
    _csv(os.path.join(raw_dir, "a.csv"), rows)
    run_incremental_ingest(spark, raw_dir, out, os.path.join(tmpdir_path, "ck"), sample_weeks=1)
    days = sorted(r.event_date.day for r in ingest.read_partitioned(spark, out).collect())
    assert days == list(range(1, 9))


def test_incremental_file_with_no_valid_rows(spark, tmpdir_path):
    raw_dir = os.path.join(tmpdir_path, "raw")
    out = os.path.join(tmpdir_path, "processed")
    os.makedirs(raw_dir)
    _csv(os.path.join(raw_dir, "bad.csv"), [_row("garbage"), _row("2024-01-01 01:00:00 UTC", etype="x")])
    assert run_incremental_ingest(spark, raw_dir, out, os.path.join(tmpdir_path, "ck"))["batches"] == 1
    r = ingest_log(spark, os.path.join(tmpdir_path, "ck")).first()
    assert r.unparsed_rows == 1
    assert r.total_rows == 2 and r.processed_rows == 0 and r.invalid_event_types == 1


def test_staging_table_and_summary(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "f.csv")
    _csv(path, [_row("2024-01-01 01:00:00 UTC", user=1), _row("2024-01-03 02:00:00 UTC", user=2)])
    clean = ingest.clean_events(read_raw_csv(spark, path))
    spark.sql("DROP TABLE IF EXISTS shoplens_test_staging")
    ingest.write_staging_table(clean, "shoplens_test_staging")
    t = spark.table("shoplens_test_staging")
    assert t.count() == 2
    assert dict(t.dtypes)["price"] == "decimal(12,2)"
    s = ingest.load_summary(t).first()
    assert (s.total_rows, s.unique_users, s.unique_products) == (2, 2, 1)
    assert (s.min_date, s.max_date) == (dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    spark.sql("DROP TABLE shoplens_test_staging")


def test_replay_after_crash_is_idempotent(spark, tmpdir_path, monkeypatch):
    """A crash after a batch wrote its files but before its ledger entry:
    the next run redoes that batch and the output is unchanged."""
    from shoplens.streaming import incremental
    raw_dir = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw_dir)
    _csv(os.path.join(raw_dir, "a.csv"), [_row("2024-01-01 01:00:00 UTC", user=1),
                                          _row("2024-01-02 01:00:00 UTC", user=1)])
    _csv(os.path.join(raw_dir, "b.csv"), [_row("2024-01-02 05:00:00 UTC", user=2),
                                          _row("2024-01-03 05:00:00 UTC", user=2)])
    whole = incremental._run_batch

    def dies(spark, paths, *rest):
        out = whole(spark, paths, *rest)
        if paths[0].endswith("b.csv"):
            raise RuntimeError("lost")
        return out
    monkeypatch.setattr(incremental, "_run_batch", dies)
    with pytest.raises(RuntimeError, match="lost"):
        _run(spark, tmpdir_path)
    before = _rows(spark, tmpdir_path)
    monkeypatch.setattr(incremental, "_run_batch", whole)
    assert [f["file"] for f in _run(spark, tmpdir_path)["files"]] == ["b.csv"]
    assert _rows(spark, tmpdir_path) == before
    assert _run(spark, tmpdir_path)["batches"] == 0


def test_many_files_per_batch_keep_per_file_sample(spark, tmpdir_path):
    raw_dir = os.path.join(tmpdir_path, "raw")
    out = os.path.join(tmpdir_path, "processed")
    os.makedirs(raw_dir)
    now = time.time()
    # file a starts Jan 1, file b starts Jan 10: each keeps its own first 8 days
    _csv(os.path.join(raw_dir, "a.csv"),
         [_row(f"2024-01-{d:02d} 01:00:00 UTC", user=1) for d in range(1, 20)], now - 20)
    _csv(os.path.join(raw_dir, "b.csv"),
         [_row(f"2024-01-{d:02d} 05:00:00 UTC", user=2) for d in range(10, 28)], now - 10)
    n = run_incremental_ingest(spark, raw_dir, out, os.path.join(tmpdir_path, "ck"),
                               sample_weeks=1, files_per_batch=10, mode="per_file")
    assert n["batches"] == 1
    got = ingest.read_partitioned(spark, out).collect()
    assert sorted(r.event_date.day for r in got if r.user_id == 1) == list(range(1, 9))
    assert sorted(r.event_date.day for r in got if r.user_id == 2) == list(range(10, 18))
