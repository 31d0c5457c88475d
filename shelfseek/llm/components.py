"""Connected components of a table of links, as joins that each halve the way to the smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfseek.scratch import stored


def components(links: DataFrame) -> DataFrame:
    """(v, label) for each node of ``links`` (u, v, both bigint): the smallest node it is connected with.

    Each round takes the smallest label among a node's neighbours and then the label of that label; nothing is
    gathered per component, and the smallest label is combined before each shuffle.
    """
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = stored(both.filter("u <> v").distinct(), "components-edges")
    nearest = edges.groupBy("u").agg(F.min("v").alias("label"))
    labels = stored(nearest.select(F.col("u").alias("v"), F.least("u", "label").alias("label")), "components")
    while True:
        near = (
            edges.join(labels.select(F.col("v"), "label"), "v")
            .groupBy("u")
            .agg(F.min("label").alias("near"))
            .select(F.col("u").alias("v"), "near")
        )
        lowered = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        lowered = stored(lowered, "components")
        target = lowered.select(F.col("v").alias("label"), F.col("label").alias("further"))
        jumped = lowered.join(target, "label").select("v", F.col("further").alias("label"), "old")
        jumped = stored(jumped, "components")
        if jumped.filter("label <> old").isEmpty():
            return jumped.select("v", "label")
        labels = jumped.select("v", "label")
