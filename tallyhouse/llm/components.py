"""Connected components by contraction, as joins over edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.common import stored


def contracted(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, comp) with the components that ``links`` (a, b: nodes) join made one.

    Every round hooks each label to its smallest neighbour and renames the edges, so at least half
    of the labels that still have an edge go; rounds are logarithmic. Edges and labels stay tables.
    """
    name = labels.select(F.col("node"), F.col("comp"))
    edges = links.join(name.toDF("a", "u"), "a").join(name.toDF("b", "v"), "b").select("u", "v")
    edges = stored(edges.where("u <> v").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = stored(both.groupBy("u").agg(F.min("v").alias("to")).where("to < u"), "hooks")
        labels = stored(
            labels.join(hook, labels["comp"] == hook["u"], "left").select("node", F.coalesce("to", "comp").alias("comp")),
            "labels",
        )
        left = edges.join(hook.toDF("u", "tu"), "u", "left").select(F.coalesce("tu", "u").alias("u"), "v")
        named = left.join(hook.toDF("v", "tv"), "v", "left").select("u", F.coalesce("tv", "v").alias("v"))
        edges = stored(named.where("u <> v").distinct(), "edges")
    return labels
