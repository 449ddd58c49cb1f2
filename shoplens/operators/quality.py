"""Declarative column tests: not_null, accepted_values, unique.

Failures count what the test query returns: NULL rows for not_null, distinct
unexpected values for accepted_values (NULLs pass) and distinct repeated
values for unique (NULLs ignored).

All rules of a table are judged in one scan.  The not_null counts are kept per
task while the row's values of the other rules are tagged with their rule and
counted per (rule, value), a partial aggregate; accepted_values passes on
unexpected values only.  A second grouping counts the failing values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ("table_name", "column_name", "test_name", "failures")


@dataclass(frozen=True)
class Rule:
    column: str
    test: str                      # not_null | accepted_values | unique
    values: Sequence = field(default_factory=tuple)


def _value(rule: Rule) -> Column:
    """What a row contributes to a rule as text, NULL if nothing: the value to
    count, or for not_null a mark."""
    c = F.col(rule.column)
    if rule.test == "not_null":
        return F.when(c.isNull(), F.lit(""))
    if rule.test == "accepted_values":
        return F.when(c.isNotNull() & ~c.isin(*rule.values), c.cast("string"))
    if rule.test == "unique":
        return c.cast("string")
    raise ValueError(rule.test)


def table_report(table: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame | None:
    """(table_name, column_name, test_name, failures) of a table's rules."""
    if not rules:
        return None
    entry = "struct<rule:int,value:string>"
    given = F.array(*[F.when(_value(r).isNotNull(), F.struct(F.lit(i).alias("rule"), _value(r).alias("value")))
                      .cast(entry) for i, r in enumerate(rules)])
    per_value = (df.select(F.explode(given).alias("_x")).where("_x IS NOT NULL")
                 .groupBy("_x.rule", "_x.value").agg(F.count(F.lit(1)).alias("n")))
    failures = []
    for i, r in enumerate(rules):
        own = F.col("rule") == i
        failures.append(F.sum(F.when(own, F.col("n"))) if r.test == "not_null" else
                        F.count_if(own & (F.col("n") > 1)) if r.test == "unique" else F.count_if(own))
    counts = per_value.agg(*[F.coalesce(f, F.lit(0)).cast("long").alias(f"_f{i}") for i, f in enumerate(failures)])
    pairs = ", ".join(f"'{r.column}', '{r.test}', _f{i}" for i, r in enumerate(rules))
    return counts.selectExpr(f"'{table}' AS table_name",
                             f"stack({len(rules)}, {pairs}) AS (column_name, test_name, failures)")


def dq_report(tables: dict[str, DataFrame], rules: dict[str, Sequence[Rule]]) -> DataFrame:
    """(table_name, column_name, test_name, failures) for every rule."""
    out = None
    for name, table_rules in rules.items():
        rep = table_report(name, tables[name], table_rules)
        if rep is not None:
            out = rep if out is None else out.unionByName(rep)
    return out
