"""Connected components of a link table, by contraction: nothing is collected, and copies of a link meet map-side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.llm.work import staged


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component``, the smallest id reachable, for every id in links (a, b) of two integers.

    Each round lets every node point to its smallest neighbour, follows the pointers once, and replaces the links by links
    between what is pointed to, without loops and repeats. At least half of the nodes go in every round. Links with a null
    end are ignored; no links give no rows. Every round is written to the shared folder, so lineage stays short.
    """
    links = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = staged(links.distinct(), "links")
    labels = None
    while labels is None or not links.isEmpty():
        ends = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        up = staged(ends.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low")).select("id", F.least("id", "low").alias("up")), "pointers")
        over = up.select(F.col("id").alias("up"), F.col("up").alias("top"))
        up = staged(up.join(over, "up").select("id", F.col("top").alias("up")), "pointers")
        if labels is None:
            labels = up.withColumnRenamed("up", "component")
        else:
            moved = up.select(F.col("id").alias("component"), F.col("up").alias("top"))
            labels = staged(labels.join(moved, "component", "left").select("id", F.coalesce("top", "component").alias("component")), "labels")
        of_a, of_b = up.select(F.col("id").alias("a"), F.col("up").alias("a2")), up.select(F.col("id").alias("b"), F.col("up").alias("b2"))
        moved = links.join(of_a, "a").join(of_b, "b").where("a2 <> b2")
        links = staged(moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "links")
    return labels
