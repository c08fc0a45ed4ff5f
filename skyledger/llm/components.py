"""Connected components of a link table, in a few shuffles per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import materialise


def _star(pairs: DataFrame, low: bool) -> DataFrame:
    """Hang the larger (or, if ``low``, the smaller) neighbours of each node below
    the smallest node among it and its neighbours."""
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    if low:
        hung = pairs.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    else:
        hung = pairs.filter(F.col("b") > F.col("a")).join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
    return hung.filter("a != b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``); root is the smallest node.

    Large and small stars alternate until nothing changes, which takes a number of
    rounds that grows with the logarithm of the longest chain. Only minima are
    computed per node, so a node with very many links is no unbounded group, and
    each round starts from a table in the shared folder.
    """
    edges = materialise(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a != b").distinct(),
        "links",
    )
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = materialise(_star(_star(both, low=False), low=True), "links")
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if not state[0] or tuple(state) == seen:
            break
        seen = tuple(state)
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
