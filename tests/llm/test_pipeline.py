import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.conftest import SCHEMA
from tests.oracle_check import compare, duck_conn

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_stages_hand_on_the_columns(spark, docs, tmpdir_path):
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmpdir_path}/{name}")
        after = spark.read.parquet(f"{tmpdir_path}/{name}")
        assert after.count() <= now.count()
        now = after
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == \
        {r.doc_id for r in now.select("doc_id").distinct().collect()}


def test_stages_take_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_run(spark):
    out = entry.queries()["pipeline"](spark, SF)
    sizes = out.groupBy("sequence_id").sum("length").collect()
    assert sizes and all(r[1] <= 1024 for r in sizes)


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_query_matches_oracle(spark, name):
    df = entry.queries()[name](spark, SF)
    res = duck_conn(SF).execute(entry.oracle_sql()[name])
    msgs = compare([tuple(r) for r in df.collect()], df.columns, res.fetchall(),
                   [d[0] for d in res.description])
    assert not msgs, msgs


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert "pipeline" in names
