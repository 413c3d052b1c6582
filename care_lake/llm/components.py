"""Connected components of a table of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_lake.session import staged


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node`` and ``label``, the smallest node reachable; nodes without link are absent.

    Each round, a node takes the smallest label among its own and its neighbours', then the label of that label.
    Labels are written between rounds, so a round never repeats those before it. Null ends are ignored, and
    loops and repeated links change nothing.
    """
    ends = links.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null")
    both = staged(ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    labels = staged(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least")).select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        taken = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        taken = staged(taken.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        labels = taken.select("node", "label")
        if taken.where("old != label").isEmpty():
            return labels
