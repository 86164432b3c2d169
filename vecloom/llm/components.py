"""Connected components of links, without bringing a component into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node in links (a, b): the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so paths shorten geometrically. Groups are only ever folded to a minimum, with
    map-side aggregation; every round is written out, so a lost executor costs one read.
    An empty table gives no rows. Links with a null end are left out.
    """
    links = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a != b")
    both = stage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stage(
        both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")), "labels"
    )
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        hooked = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("component")
        )
        hooked = stage(hooked, "hooked")
        target = labels.select(F.col("node").alias("at"), F.col("component").alias("beyond"))
        jumped = hooked.join(target, F.col("component") == F.col("at"), "left").select(
            "node", "before", F.least("component", "beyond").alias("component")
        )
        jumped = stage(jumped, "labels")
        labels = jumped.select("node", "component")
        if jumped.where("component != before").isEmpty():
            return labels
