"""Joins of tables that grow with the corpus deal out both sides by the key:
Spark's size of such a table says little about the memory that it takes."""

from collections import defaultdict

import pytest

from shoplens.llm import components, decontaminate, line_dedup, simhash
from shoplens.llm.common import materialize


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def plans(monkeypatch):
    """name -> the plans of the tables stored under that name."""
    found = defaultdict(list)

    def noted(df, name):
        found[name].append(plan_of(df))
        return materialize(df, name)
    for module in (components, decontaminate, line_dedup, simhash):
        monkeypatch.setattr(module, "materialize", noted)
    return found


def broadcasts(plans, last):
    return sorted(name for name, every in {**plans, "result": [plan_of(last)]}.items()
                  if any("BroadcastHashJoin" in p for p in every))


def near(docs):
    """``docs`` and texts that differ by a few words of many."""
    words = [f"v{k * k % 211}" for k in range(400)]
    more = [(7000 + k, " ".join(words + [f"z{k // 4}"]), "en", "s", 1) for k in range(12)]
    return docs.unionByName(docs.sparkSession.createDataFrame(more, docs.schema))


def test_simhash(plans, docs):
    # The least names of the components come from an aggregate, whose size is known by then.
    groups = simhash.near_groups(near(docs))
    assert set(broadcasts(plans, groups)) <= {"components"} and plans["jumped"]
    kept = simhash.keep_one(near(docs))
    assert set(broadcasts(plans, kept)) <= {"components"} and plans["twice"]


def test_line_dedup(plans, docs):
    out = line_dedup.dedup_lines(docs)
    assert broadcasts(plans, out) == [] and plans["moved"]


def benchmark(spark):
    text = " ".join(f"w{k % 37}" for k in range(40))
    return spark.createDataFrame([(1, text), (2, text[9:]), (3, "two words"), (None, "one")],
                                 "item_id long, text string")


@pytest.mark.parametrize("few", [True, False])
def test_decontaminate(plans, spark, docs, monkeypatch, few):
    if not few:
        monkeypatch.setattr(decontaminate, "SMALL_TOKENS", 0)
    more = spark.createDataFrame([(8000 + k, " ".join(f"w{j % 37}" for j in range(k, 60)), "en", "s", 1)
                                  for k in range(9)], docs.schema)
    every = docs.unionByName(more)
    found = decontaminate.overlaps(every, benchmark(spark))
    out = decontaminate.decontaminate(every, benchmark(spark))
    assert {r.doc_id for r in found.collect()} == {2003, 2004, *range(8000, 8009)}
    assert out.count() == every.count() - 11
    names = broadcasts(plans, out)
    assert names == (["contaminated", "hits"] if few else [])
