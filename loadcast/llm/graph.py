"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.session import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label``, the smallest node that can be reached, for every linked node.

    Each round a node takes the smallest label among its neighbours', then the label of its
    label, so that long chains shorten by half or more. Rounds go on until no label changes.
    Labels are written to the shared folder after each round. Nulls are not linked.
    """
    links = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    both = stage(
        links.select(F.col(a).alias("node"), F.col(b).alias("near"))
        .unionByName(links.select(F.col(b).alias("node"), F.col(a).alias("near")))
        .distinct(),
        "links",
    )
    labels = stage(
        both.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("label")), "labels"
    )
    while True:
        of_near = labels.select(F.col("node").alias("near"), F.col("label").alias("near_label"))
        lowest = both.join(of_near, "near").groupBy("node").agg(F.min("near_label").alias("near_label"))
        taken = labels.join(lowest, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near_label").alias("next")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        after = stage(
            taken.join(jump, "next", "left").select(
                "node", "was", F.least("next", F.coalesce("beyond", "next")).alias("label")
            ),
            "labels",
        )
        labels = after.select("node", "label")
        if after.where(F.col("was") != F.col("label")).isEmpty():
            return labels
