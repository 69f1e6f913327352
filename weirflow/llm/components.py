"""Connected components of links, and how many links each member has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import written


def components(links: DataFrame) -> DataFrame:
    """Each linked form with the least form of its component, by spreading the least label along the links until none changes.

    Labels are written between rounds, so neither lineage nor a lost executor costs more than one round.
    """
    edges = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label")), "labels")
    while True:
        spread = edges.join(labels.select(F.col("a").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        # A form also takes the label of its label, so long chains shrink by half in a round.
        after = labels.join(spread, "a").select("a", F.least("label", "near").alias("next"), "label")
        jump = after.select(F.col("a").alias("next"), F.col("next").alias("further"))
        labels_next = written(after.join(jump, "next", "left").select("a", F.least("next", F.coalesce("further", "next")).alias("label"), (F.least("next", F.coalesce("further", "next")) != F.col("label")).alias("changed")), "labels")
        if labels_next.where("changed").isEmpty():
            return labels_next.select(F.col("a").alias("form"), "label")
        labels = labels_next.select("a", "label")


def degrees(links: DataFrame) -> DataFrame:
    """Number of links of each linked form."""
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.count("*").alias("links")).select(F.col("a").alias("form"), "links")
