"""Which changes of a redelivered, out-of-order feed still count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators.ordered import HOT_ROWS, Running, chunk_of, running

ARRIVAL = ("seq", "event_id")
# What a change is about: types number their items each on their own, and an item's file content is kept apart.
ITEM_KEY = ("item_type", "type", "ID")


def of_items() -> Column:
    """Rows that freshness judges: items and file contents of the core types."""
    return F.col("item_type").isin(fixed.ITEM_TYPES) & F.col("type").isin(fixed.TYPE_ITEM, fixed.TYPE_FILE_CONTENT)


def _judged(keys: Sequence[str]) -> Column:
    return of_items() if {"item_type", "type"} <= set(keys) else F.lit(True)


def judge(
    changes: DataFrame,
    keys: Sequence[str] = ITEM_KEY,
    arrival: Sequence[str] = ARRIVAL,
    chunk: Column | None = None,
    strict: bool = True,
    state: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``verdict`` (valid, stale or tombstoned) to every change, in arrival order per key.

    A create or delete always counts, and so does what is no item or file content of a core type. An update counts if its InsertTime equals the newest seen so far and no
    delete came before. ``strict`` keeps a key dead after its first delete; otherwise a create starts it afresh.
    ``state`` (see ``fold_state``, strict only) is what earlier batches of the feed have seen.
    """
    if state is not None and not strict:
        raise ValueError("carried state is kept for the strict rule only")
    chunk = chunk_of(F.col(arrival[0])) if chunk is None else chunk
    order = [F.col(c) for c in arrival]
    is_delete = F.col("Action") == fixed.ACTION_DELETE
    scope = list(keys)
    rows = changes
    if not strict:
        created = F.when(F.col("Action") == fixed.ACTION_CREATE, 1).otherwise(0)
        rows = running(rows, scope, order, chunk, Running("__life", "sum", created), limit=hot_rows)
        scope.append("__life")
    seen = running(
        rows,
        scope,
        order,
        chunk,
        Running("__newest", "max", F.when(~is_delete, F.col("InsertTime"))),
        Running("__deleted", "max", F.when(is_delete, 1).otherwise(0), before=True),
        limit=hot_rows,
    )
    newest, deleted = F.col("__newest"), F.coalesce(F.col("__deleted"), F.lit(0))
    if state is not None:
        before = state.select(
            *[F.col(k).alias(f"__s_{k}") for k in keys], F.col("newest").alias("__s_newest"),
            F.col("deleted").alias("__s_deleted"),
        )
        seen = seen.join(before, [F.col(k) == F.col(f"__s_{k}") for k in keys], "left")
        newest = F.greatest(newest, F.col("__s_newest"))
        deleted = F.greatest(deleted, F.coalesce(F.col("__s_deleted"), F.lit(0)))
    verdict = (
        F.when(F.col("Action").isin(fixed.ACTION_DELETE, fixed.ACTION_CREATE) | ~_judged(keys), "valid")
        .when(deleted == 1, "tombstoned")
        .when(F.col("InsertTime") == newest, "valid")
        .otherwise("stale")
    )
    return seen.select(*changes.columns, verdict.alias("verdict"))


def fold_state(changes: DataFrame, state: DataFrame | None = None, keys: Sequence[str] = ITEM_KEY) -> DataFrame:
    """Freshness state after a batch: newest InsertTime and whether a delete was seen, one row per key."""
    is_delete = F.col("Action") == fixed.ACTION_DELETE
    rows = changes.where(_judged(keys)).select(
        *keys,
        F.when(~is_delete, F.col("InsertTime")).alias("newest"),
        F.when(is_delete, 1).otherwise(0).alias("deleted"),
    )
    if state is not None:
        rows = rows.unionByName(state.select(*keys, "newest", "deleted"))
    return rows.groupBy(*keys).agg(F.max("newest").alias("newest"), F.max("deleted").alias("deleted"))


def forget_types(state: DataFrame, removed: DataFrame, column: str = "item_type") -> DataFrame:
    """State without the keys of removed types."""
    return state.join(removed.select(column).distinct(), column, "left_anti").select(*state.columns)


def without_old_tombstones(state: DataFrame, changes: DataFrame, age: int) -> DataFrame:
    """State without deleted keys whose newest change lies ``age`` or more before the newest of a batch: what comes that
    late is taken for new."""
    now = changes.agg(F.max("InsertTime")).scalar()
    return state.where((F.col("deleted") == 0) | F.col("newest").isNull() | (F.col("newest") > now - F.lit(age)) | now.isNull())


def fresh(changes: DataFrame, **options) -> DataFrame:
    """Only the changes that count."""
    return judge(changes, **options).where(F.col("verdict") == "valid").drop("verdict")
