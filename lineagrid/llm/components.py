"""Connected components by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineagrid.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of ``edges`` (a, b).

    In each round a node takes the smallest label among its neighbours' and its
    own, then the label of that label, so long chains shrink by half. Rounds are
    stored; only the number of changed labels comes to the driver.
    """
    both = stored(
        edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges"
    )
    labels = stored(
        both.groupBy("a").agg(F.min("b").alias("n"))
        .select(F.col("a").alias("node"), F.least("a", "n").alias("component")),
        "labels",
    )
    changed = 1
    while changed:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(
            F.col("a").alias("node")
        ).agg(F.min("component").alias("near"))
        took = labels.join(near, "node").select(
            "node", "component", F.least("component", "near").alias("low")
        )
        took = stored(took, "labels")
        of_label = took.select(F.col("node").alias("at"), F.col("low").alias("jump"))
        after = stored(
            took.join(of_label, took["low"] == of_label["at"]).select(
                "node", F.least("low", "jump").alias("component"), F.col("component").alias("was")
            ),
            "labels",
        )
        changed = after.filter("component <> was").limit(1).count()
        labels = after.select("node", "component")
    return labels
