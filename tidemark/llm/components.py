"""Connected components of a graph of links, by tables alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sinks.staging import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` of every node that has a link; the label is the component's least node.

    Every round takes the least label among a node and its neighbours and then the label of
    that label, so that chains shorten by half or more.  A round is written to the shared folder,
    which cuts the lineage; only the number of changed labels reaches the driver.  No links
    give no rows.
    """
    one_way = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = stage(one_way.unionByName(one_way.selectExpr("other AS node", "node AS other")))
    labels = stage(
        both.groupBy("node").agg(F.min("other").alias("m")).selectExpr("node", "least(node, m) AS label")
    )
    while True:
        lent = labels.selectExpr("node AS other", "label AS lent")
        nearest = both.join(lent, "other").groupBy("node").agg(F.min("lent").alias("m"))
        met = labels.join(nearest, "node").selectExpr("node", "label AS old", "least(label, m) AS near")
        jump = labels.selectExpr("node AS near", "label AS far")
        new = stage(met.join(jump, "near").selectExpr("node", "old", "least(near, far) AS label"))
        if new.where("label < old").isEmpty():
            return labels
        labels = new.select("node", "label")
