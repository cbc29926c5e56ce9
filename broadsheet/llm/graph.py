"""Connected groups of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of `edges` (a, b): the smallest id that can be
    reached. Each round takes the smallest label of the neighbours and then the label
    of that label, so long chains shorten by more than half; no group is ever gathered
    in one place. Links in both directions, repeated ones and loops may be given."""
    a, b = F.col("a"), F.col("b")
    both = edges.select(a, b).union(edges.select(b.alias("a"), a.alias("b")))
    both = written(both.filter("a <> b").distinct(), "links")
    labels = both.groupBy(a.alias("id")).agg(F.min("b").alias("m"))
    labels = written(labels.select("id", F.least("id", "m").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b")
        near = near.groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        step = labels.join(near, "id").select(
            "id", F.least("component", "near").alias("component"), F.col("component").alias("before")
        )
        up = labels.select(F.col("id").alias("component"), F.col("component").alias("up"))
        step = step.join(up, "component", "left").select(
            "id", F.least("component", "up").alias("component"), "before"
        )
        step = written(step, "labels")
        labels = step.select("id", "component")
        if step.filter("component <> before").isEmpty():
            return labels
