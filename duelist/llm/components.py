"""Connected components of an edge list, smallest vertex as label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``v``, ``label`` of every vertex of ``edges`` (``a``, ``b``).

    Every round a vertex takes the smallest label among its neighbours' and then that label's own label, so chains
    shorten by halves. Rounds are written tables: nothing is collected but the number of changes. Both sides of
    every join are plain scans, so AQE can split the edges of a hub.
    """
    both = staged(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("b")).selectExpr("a AS v", "least(a, b) AS label"), "labels")
    while True:
        near = both.join(labels.withColumnsRenamed({"v": "b"}), "b").groupBy("a").agg(F.min("label").alias("near"))
        stepped = staged(labels.join(near.withColumnRenamed("a", "v"), "v").selectExpr("v", "label AS old", "least(label, near) AS label"), "labels")
        jump = stepped.selectExpr("v AS label", "label AS next")
        jumped = staged(stepped.join(jump, "label").selectExpr("v", "old", "least(label, next) AS label"), "labels")
        if jumped.filter("old <> label").isEmpty():
            return jumped.select("v", "label")
        labels = jumped.select("v", "label")
