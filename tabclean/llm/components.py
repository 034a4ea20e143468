"""Connected components of a graph that may be larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize

MOST_ROUNDS = 60  # rounds grow with the logarithm of the longest chain; only a defect reaches this


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long): component is the least node.

    Large-star and small-star steps in turn until nothing changes. Every step is a grouped minimum
    (with a map-side partial) and an equality join, and is stored in the shared folder, so a lost
    executor costs a re-read. Only two numbers a round reach the driver. Loops and repeated links
    are fine; an empty input gives an empty result.
    """
    links = materialize(_directed(edges.select("a", "b")), f"{name}-0")
    last = _digest(links)
    for round_ in range(1, MOST_ROUNDS):
        links = materialize(_small_star(_large_star(links)), f"{name}-{round_}")
        now = _digest(links)
        if now == last:
            roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
        last = now
    raise RuntimeError("connected components did not settle")


def _directed(edges: DataFrame) -> DataFrame:
    """Each link once, from the greater node to the lesser."""
    return edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _digest(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return (row["n"], row["h"])


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every greater neighbour of a node on the least node around it."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    up = both.where("b > a").join(least, "a")
    return _directed(up.select(F.col("b").alias("a"), F.col("low").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its lesser neighbours on the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    down = links.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return _directed(down.union(least.select("a", F.col("low").alias("b"))))
