"""Connected components of a link table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clientlens.llm.common import release, staged


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); a component is named by its smallest node.

    Each round a node takes the smallest name among its neighbours', then the name that this name has taken
    itself, so names travel in doubling steps. The links never leave Spark; the driver sees one count a round.
    A node with very many links is combined before the shuffle, and no row holds a node's neighbours.
    """
    both = staged(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(),
        "links",
    )
    names = staged(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("component")),
        "names",
    )
    while True:
        near = both.join(names.select(F.col("node").alias("b"), F.col("component").alias("near")), "b")
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        step = names.join(near, "node").select(
            "node", F.least("component", "near").alias("name"), F.col("component").alias("was")
        )
        jumps = names.select(F.col("node").alias("name"), F.col("component").alias("next"))
        step = step.join(jumps, "name", "left").select("node", F.least("name", "next").alias("component"), "was")
        step = staged(step, "names")
        release(names)
        names = step.select("node", "component")
        names.staged_path = step.staged_path
        if not step.where("component <> was").limit(1).count():
            release(both)
            return names
