"""Connected components of a graph given as stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import dealt, materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links(a, b)``: equal labels, one
    component.  The label is the component's smallest node.

    Every round a node takes the smallest label among its neighbours, then
    its label's label, which halves long chains.  Both steps read stored
    tables, so a round never recomputes earlier ones and a label that many
    nodes share is a plain shuffle join whose large partitions are split.
    """
    both = materialize(
        links.select(F.col("a").alias("node"), F.col("b").alias("near"))
        .unionAll(links.select(F.col("b").alias("node"), F.col("a").alias("near")))
        .distinct(), "links")
    labels = materialize(
        both.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("label")), "labels")
    while True:
        seen = labels.select(F.col("node").alias("near"), F.col("label").alias("other"))
        lowest = (both.join(dealt(seen), "near").groupBy("node")
                  .agg(F.min("other").alias("lowest")))
        hooked = materialize(
            labels.join(dealt(lowest), "node")
            .select("node", F.col("label").alias("old"),
                    F.least("label", "lowest").alias("label")), "hooked")
        target = hooked.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = materialize(
            hooked.join(dealt(target), "label").select("node", "old", F.col("next").alias("label")),
            "jumped")
        labels = jumped.select("node", "label")
        if jumped.where("old != label").limit(1).count() == 0:
            return labels
