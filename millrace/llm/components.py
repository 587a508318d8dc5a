"""Connected components of an undirected graph as DataFrame joins; nothing of the graph reaches the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import looked_up, staged


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for each vertex of ``edges`` (a, b): the least vertex of its component.

    Each round every vertex takes the least label among itself and its neighbours, then the label of that label, so paths
    halve; rounds end when no label changes. A vertex with very many neighbours, and a label of very many vertices, are joined by broadcast.
    Vertices may be of any type that can be ordered. Empty edges give an empty result.
    """
    both = staged(edges.select("a", "b").where("a <> b").union(edges.selectExpr("b", "a").where("a <> b")).distinct().toDF("v", "w"))
    label = staged(both.groupBy("v").agg(F.least(F.min("w"), F.first("v")).alias("label")))
    while True:
        near = looked_up(both, label.withColumnRenamed("v", "w"), ["w"]).groupBy("v").agg(F.min("label").alias("near"))
        low = staged(label.join(near, "v").select("v", "label", F.least("label", "near").alias("low")))
        up = label.select(F.col("v").alias("low"), F.col("label").alias("jump"))
        new = staged(looked_up(low, up, ["low"], "left").select("v", F.least("low", F.coalesce("jump", "low")).alias("new"), "label"))
        if not new.where("new <> label").limit(1).count():
            return new.select("v", F.col("new").alias("label"))
        label = new.select("v", F.col("new").alias("label"))
