"""Descendants and subtrees: one join per level, every level written out before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def edges_of(nodes: DataFrame) -> DataFrame:
    """Distinct parent → child pairs; items have a row per language but one place in the tree."""
    return nodes.select(F.col("ParentID").alias("parent"), F.col("ID").alias("child")).distinct()


def descendants(nodes: DataFrame, roots: DataFrame, depth: int = 0) -> DataFrame:
    """(root, ID, level) below each root, to ``depth`` levels (0 = all).

    A pair found once is not followed again, so a cycle ends. The frontier and what was seen are written per
    level: the loop's plan stays one level deep and a lost executor rereads files.
    """
    edges = cut_lineage(edges_of(nodes))
    frontier = roots.select(F.col("ID").alias("root"), F.col("ID"))
    seen = None
    level = 0
    while depth == 0 or level < depth:
        level += 1
        found = (
            frontier.join(edges, frontier["ID"] == edges["parent"])
            .select("root", F.col("child").alias("ID"))
            .distinct()
        )
        if seen is not None:
            found = found.join(seen.select("root", "ID"), ["root", "ID"], "left_anti")
        found = cut_lineage(found.withColumn("level", F.lit(level)))
        if found.isEmpty():
            break
        seen = found if seen is None else seen.unionByName(found)
        frontier = found.select("root", "ID")
    if seen is None:
        return roots.select(F.col("ID").alias("root"), "ID", F.lit(0).alias("level")).limit(0)
    return seen


def subtree(attributes: DataFrame, roots: DataFrame | None = None, depth: int = 0) -> DataFrame:
    """Attribute tree as rows (root, ID, level): the roots are level 0, links are no children.

    Without ``roots`` the whole forest below parent 0.
    """
    nodes = attributes.where(F.col("IsLink") == 0)
    if roots is None:
        roots = nodes.where(F.col("ParentID") == 0).select("ID").distinct()
    else:
        # A root is known when it is itself no link, or when something hangs below it.
        known = nodes.select("ID").union(nodes.select("ParentID")).distinct()
        roots = roots.join(known, "ID", "left_semi")
    top = roots.select(F.col("ID").alias("root"), "ID", F.lit(0).alias("level"))
    return top.unionByName(descendants(nodes, roots, depth))
