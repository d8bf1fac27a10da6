"""Connected components of an edge table by alternating large and small stars."""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``), the component being its smallest node.

    A large star links every larger neighbour of a node to the node's smallest neighbour, a small star
    its smaller neighbours and itself; a few rounds of both leave each node linked to its component.
    Minima are aggregated before they are joined back, so a node with very many links is never gathered,
    and each round is written to the shared folder."""
    links, state = _written(_directed(edges))
    while True:
        nearer, new_state = _written(_star(_star(links, larger=True), larger=False))
        if new_state == state:
            break
        links, state = nearer, new_state
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _directed(edges: DataFrame) -> DataFrame:
    """Each link once, from its larger node ``a`` to its smaller ``b``."""
    return (edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _star(links: DataFrame, larger: bool) -> DataFrame:
    if larger:
        near = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = links
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    moved = near.join(least, "a")
    if larger:
        moved = moved.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = moved.select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
    return _directed(moved)


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links in the shared folder, and their number and digest, observed while they are written."""
    seen = Observation()
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    links = stored(links.observe(seen, F.count(F.lit(1)).alias("n"), digest.alias("digest")), "links")
    return links, (seen.get["n"], seen.get["digest"])
