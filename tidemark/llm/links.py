"""Connected components of links between longs, by alternating large-star and small-star rounds.

Every round is two map-side combined minima and two joins; its links are written to the shared folder, so the plan stays
flat and a lost executor rereads files. The loop ends once every node has one link and what it links to has none: the
components are stars then, and another round would change nothing. A node's links are never gathered: the minimum of a
hub is combined map-side and joined back, and AQE splits the hub's partition in that join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard
from tidemark.session import cut_lineage


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Link each node's larger (or smaller-or-equal) neighbours to the least node of its neighbourhood."""
    if larger:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("__m")).select("a", F.least("a", "__m").alias("__m"))
    joined = both.join(least, "a")
    if larger:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("__m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("__m").alias("b")).unionByName(
            least.select("a", F.col("__m").alias("b"))
        )
    return moved.where(F.col("a") != F.col("b")).distinct()


def _ups(links: DataFrame) -> DataFrame:
    """Every node in ``links`` and the least and largest of what it links to; a node that is linked to counts as its own."""
    own = F.struct(F.col("b").alias("node"), F.col("b").alias("up"))
    ends = links.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("up")), own)))
    return ends.groupBy("node").agg(F.min("up").alias("least"), F.max("up").alias("largest"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node in ``links`` (columns a and b)."""
    now = cut_lineage(links.select("a", "b").where(F.col("a") != F.col("b")).distinct())
    while _ups(now).agg(F.max(F.col("least") != F.col("largest"))).first()[0]:
        before, now = now, cut_lineage(_star(_star(now, True), False))
        # What a round read, shuffled and broadcast goes before the next, so the driver doesn't gather it over the rounds.
        discard(before)
    return _ups(now).select("node", F.col("least").alias("root"))
