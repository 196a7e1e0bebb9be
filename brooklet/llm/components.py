"""Connected components of an edge table, without ever holding the graph in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brooklet.llm.common import written


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, label): the smallest node that the edges (a, b) reach, for every node of an edge.

    Each round gives a node the smallest label among its own and its neighbours', then the label of
    that label, so that labels travel twice as far each round. Minima are combined before each
    exchange, so a node with very many edges sends one row per task. Every round is a written table.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(both, f"{name}-edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), f"{name}-labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
        near = labels.join(seen.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = written(near.join(far, "label").select("node", "old", F.least("label", "next").alias("label")), f"{name}-labels")
        labels = after.select("node", "label")
        if after.where("old <> label").isEmpty():
            return labels
