"""Physical-plan shape of every registered query."""

import contextlib
import io
import os
import re

import pytest

import __spark_entry__ as entry
from shoplens import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _plan(df):
    """The physical plan text, as ``DataFrame.explain()`` prints it."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_pairwise_or_expanding_operators(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "PythonUDF",
               "BatchEvalPython", "ArrowEvalPython"):
        assert op not in plan, f"{name}: {op}"


def test_events_scan_is_pruned(spark):
    plan = _plan(entry.queries()["mart_funnel_daily"](spark, SF))
    # the funnel never reads part's brand or retail price
    assert "p_retailprice" not in plan and "p_brand" not in plan


def test_date_filter_reaches_parquet(spark, tmpdir_path):
    from shoplens.plans import bi
    from shoplens.plans.warehouse import MaterializedWarehouse
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    wh = MaterializedWarehouse(spark, SF, tmpdir_path)
    wh.run_ingest()
    fact = wh.build("fact")
    plan = _plan(bi.daily_kpi(fact, start_date="2024-01-10", end_date="2024-01-12"))
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date#\d+\), \(event_date#\d+ >= 2024-01-10\)", plan)
    assert bi.daily_kpi(fact, start_date="2024-01-10", end_date="2024-01-12").count() == 3
    events = wh.clean.where("event_date = DATE'2024-01-05'")
    assert "PartitionFilters: [isnotnull(event_date" in _plan(events)


def test_first_partitions_prunes_folders(spark, tmpdir_path):
    from shoplens.plans import ingest
    from shoplens.plans.warehouse import Warehouse
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    ingest.write_partitioned(Warehouse(spark, SF).clean, tmpdir_path + "/ev")
    ev = ingest.read_partitioned(spark, tmpdir_path + "/ev")
    df = ingest.first_partitions(ev, 3)
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date#\d+\), \(event_date#\d+ <= ReusedSubquery"
                     r"|PartitionFilters: \[isnotnull\(event_date#\d+\), \(event_date#\d+ <= Subquery", _plan(df))
    assert df.count() == ev.where("event_date <= DATE'2024-01-03'").count()


def test_hot_user_is_split(spark, tmpdir_path):
    """90 % of the rows on one user: the join of the stored first dates is
    split by adaptive execution, and the funnel reads the stored fact."""
    from pyspark.sql import functions as F

    from shoplens.plans import facts, marts
    from shoplens.plans.staging import stg_events
    from shoplens.plans.warehouse import materialize
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        events = spark.range(0, 120_000, 1, 8).select(
            F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id)").alias("event_timestamp"),
            F.expr("date'2024-01-01' + cast(id % 20 as int)").alias("event_date"),
            F.lit("view").alias("event_type"), (F.col("id") % 50).alias("product_id"),
            F.lit(1).cast("long").alias("category_id"), F.lit("a.b").alias("category_code"),
            F.lit("x").alias("brand"), F.lit(1).cast("decimal(12,2)").alias("price"),
            F.when(F.col("id") % 10 != 0, 1).otherwise(F.col("id")).cast("long").alias("user_id"),
            F.col("id").cast("string").alias("user_session"))
        stg = materialize(stg_events(events), tmpdir_path + "/stg")
        first = materialize(facts.user_first_dates(stg), tmpdir_path + "/first")
        fact = facts.fact_events(stg, first)
        fact.write.format("noop").mode("overwrite").save()
        fact.collect()
        assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()
        stored = materialize(fact, tmpdir_path + "/fact", "event_date")
        assert "Join" not in _plan(marts.funnel_daily(stored))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _event_scans(df):
    """Scans of the events table in the executed plan (reused ones not)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return len(re.findall(r"FileScan parquet \[event_id|FileScan parquet \[[^\]]*event_id", final))


@pytest.mark.parametrize("name, most", [("check_latest_funnel", 2), ("mart_retention_cohort_weekly", 2),
                                        ("kpi_dau", 1), ("bi_kpi_cards", 2), ("fact_events", 2),
                                        ("mart_funnel_daily", 2), ("mart_category_growth_weekly", 1)])
def test_event_scans(spark, name, most):
    assert _event_scans(registry.queries()[name](spark, SF)) <= most
