"""Numbering by ranges: no range follows a hot key."""

import pytest
from pyspark.sql import functions as F

from shoplens.llm import ordering
from shoplens.llm.common import materialize


@pytest.mark.parametrize("key", ["if(id % 3 = 0, null, id)", "1", "if(id % 10 > 0, 7, id)"])
def test_equal_keys_spread_over_the_ranges(spark, monkeypatch, key):
    """Equal or missing keys, even whole equal rows, fill all ranges evenly."""
    seen = []
    real = ordering.materialize
    monkeypatch.setattr(ordering, "materialize", lambda df, name: (seen.append(real(df, name)), seen[-1])[1])
    df = materialize(spark.range(40_000).select(F.expr(key).cast("long").alias("k"), (F.col("id") % 2).alias("g")), "t")
    out = ordering.numbered(df, ["k"], "g")
    assert out.agg(F.count_distinct("g", "position")).first()[0] == 40_000
    per_range = sorted(r["count"] for r in seen[0].groupBy("__order_part").count().collect())
    assert len(per_range) == 4 and per_range[-1] <= 2 * per_range[len(per_range) // 2]
