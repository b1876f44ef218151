"""Nest rows below their owner without ever building an unbounded array.

Every owner's rows are cut into parts by their position in sort order: rows 0 to ``limit`` - 1 are part 0, the next part 1,
and so on, so reading the parts in turn gives the rows in order, whatever an owner's size. With weights (rows that hold
rows of their own) a part begins where the weights before it pass a multiple of the limit. Positions come from a running
sum that cuts hot owners into chunks; an owner's parts are groups of their own, and every input row is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import HOT_ROWS, Running, running

# Rows (or the weight of rows) of one part.
PART_ROWS = 10_000


def in_parts(
    df: DataFrame,
    owner: Sequence[str],
    order: Sequence[str],
    limit: int = PART_ROWS,
    weight: Column | None = None,
    hot: DataFrame | bool | None = None,
    hot_rows: int = HOT_ROWS,
    single: bool = False,
) -> DataFrame:
    """Rows with ``__part``. ``order`` must be total within an owner. ``hot`` are the owners to cut into chunks of
    ``hot_rows``, where the caller has counted them on a narrower table; False if there are none. ``single``: the caller
    knows that all of an owner's rows are one part."""
    if single:
        return df.withColumn("__part", F.lit(0))
    before = Running("__before", "sum", F.lit(1).cast("bigint") if weight is None else weight, before=True)
    placed = running(df, owner, [F.col(c) for c in order], None, before, hot=hot, limit=hot_rows)
    part = F.floor(F.coalesce("__before", F.lit(0)) / F.lit(limit)).cast("int")
    return placed.withColumn("__part", part).drop("__before")


def sorted_list(item: Column, by: Sequence[str] | None = None) -> Column:
    """Collected items in order; ``by`` names struct fields to order by when the item holds maps."""
    rows = F.collect_list(item)
    if by is None:
        return F.sort_array(rows)

    def compare(x: Column, y: Column) -> Column:
        left, right = F.struct(*[x[c] for c in by]), F.struct(*[y[c] for c in by])
        return F.when(left < right, -1).when(left > right, 1).otherwise(0)

    return F.array_sort(rows, compare)


def gather(
    df: DataFrame,
    owner: Sequence[str],
    item: Column,
    order: Sequence[str],
    name: str = "rows",
    limit: int = PART_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows of each owner as sorted arrays: (owner…, part, ``name``). ``item`` must sort like ``order``."""
    rows = in_parts(df, owner, order, limit, hot_rows=hot_rows)
    lists = rows.groupBy(*owner, "__part").agg(sorted_list(item).alias(name))
    return lists.select(*owner, F.col("__part").alias("part"), name)


def gather_by_attribute(
    df: DataFrame,
    owner: Sequence[str],
    item: Column,
    by: Sequence[str],
    name: str,
    limit: int = PART_ROWS,
    weight: Column | None = None,
    fields: Sequence[str] | None = None,
    hot: DataFrame | bool | None = None,
    hot_rows: int = HOT_ROWS,
    single: bool = False,
) -> DataFrame:
    """Rows of each owner as attribute → sorted array: (owner…, part, ``name``, ``name``_weight).

    ``by`` orders the rows of an attribute; ``fields`` are the item's fields of that order, if named otherwise.
    Parts run through all attributes of an owner in turn. The running sum's shuffle on the owner serves both groupings,
    and the join of the result back to its owner.
    """
    weight = F.lit(1).cast("bigint") if weight is None else weight
    rows = in_parts(df, owner, ["AttributeID", *by], limit, weight, hot, hot_rows, single)
    # A single part needs no number to group by.
    key = list(owner) if single else [*owner, "__part"]
    narrow = rows.select(
        *key, F.col("AttributeID").cast("string").alias("__attribute"), item.alias("__item"), weight.alias("__weight")
    )
    if single:
        # An owner's rows lie in one task: sorted once, both groupings and the join to the owner read them as they come.
        narrow = narrow.sortWithinPartitions(*key, "__attribute", *[F.col("__item")[c] for c in fields or by])
    lists = narrow.groupBy(*key, "__attribute").agg(
        sorted_list(F.col("__item"), fields or by).alias("__rows"), F.sum("__weight").alias("__w")
    )
    # Said, not done again: lists come in that order.
    held = (lists.sortWithinPartitions(*key) if single else lists).groupBy(*key).agg(
        F.map_from_entries(F.collect_list(F.struct("__attribute", "__rows"))).alias(name),
        F.sum("__w").alias(f"{name}_weight"),
    )
    part = F.lit(0) if single else F.col("__part")
    return held.select(*owner, part.alias("part"), name, f"{name}_weight")
