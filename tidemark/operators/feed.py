"""Polling, routing and completion of the change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.labels import effective_priority, export_type, is_taken
from tidemark.operators.ordered import CHUNK_WIDTH, Running, running
from tidemark.operators.sizes import measured

POLLED_ACTIONS = [fixed.ACTION_UPDATE, fixed.ACTION_DELETE, fixed.ACTION_CREATE, fixed.ACTION_INITIAL]


def pending(changes: DataFrame, consumer: int) -> DataFrame:
    """Changes this consumer has not taken yet."""
    return changes.where(F.col("Action").isin(POLLED_ACTIONS) & ~is_taken("ProducerStatus", consumer))


def poll(changes: DataFrame, consumer: int, arrival: tuple[str, ...], size: int = fixed.POLL_BATCH) -> DataFrame:
    """The next batch: highest priority first, then arrival order."""
    return pending(changes, consumer).orderBy(F.desc("JMSPriority"), *arrival).limit(size)


def outgoing(polled: DataFrame) -> DataFrame:
    """A polled row as it is sent: the initial load gets the priority of its kind."""
    return polled.withColumns(
        {"sent_priority": effective_priority("JMSPriority", "type"), "export_type": export_type("JMSPriority")}
    )


def in_batches(
    changes: DataFrame,
    consumer: int,
    arrival: tuple[str, ...],
    size: int = fixed.POLL_BATCH,
    width: int = CHUNK_WIDTH,
) -> DataFrame:
    """All pending changes cut into successive polls: ``batch``, and the batch's newest InsertTime so far.

    The poll number is a global rank, counted per (priority, arrival chunk) instead of in one sorted task.
    """
    descending = -F.col("JMSPriority")
    chunk = F.struct(descending.alias("p"), F.floor(F.col(arrival[0]) / width).alias("c"))
    ranked = running(
        pending(changes, consumer), [], [descending, *[F.col(c) for c in arrival]], chunk, Running("__rank", "count")
    )
    batched = ranked.withColumn("batch", F.floor((F.col("__rank") - 1) / size))
    so_far = Window.partitionBy("batch").orderBy("__rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return batched.withColumn("high_water", F.max("InsertTime").over(so_far)).drop("__rank")


def route(
    changes: DataFrame,
    supported_types: list[str],
    subscriber: str,
    handles_initial: bool = True,
    correlation: str = fixed.PRIMARY_CORRELATION,
) -> DataFrame:
    """Changes a subscriber has to handle: a type it supports, addressed to all or to it, and no initial load
    unless it wants one. Needs the columns item_type, correlation_id and sent_priority."""
    addressed = F.col("correlation_id").contains(correlation) | F.col("correlation_id").contains(subscriber)
    wanted = F.col("item_type").isin(supported_types) & addressed
    if not handles_initial:
        wanted = wanted & ~F.col("sent_priority").isin(fixed.PRIORITY_ITEM, fixed.PRIORITY_CONFIGURATION_MAPPING)
    return changes.where(wanted)


def mark_taken(changes: DataFrame, taken: DataFrame, consumer: int) -> DataFrame:
    """Set the consumer's bit on the rows of a sent batch, bounded by the batch's newest InsertTime.

    ``taken`` holds one (ID, high_water) row per sent id.
    """
    sent = taken.groupBy(F.col("ID").alias("__id")).agg(F.max("high_water").alias("__high"))
    hit = (F.col("InsertTime") <= F.col("__high")) & ~is_taken("ProducerStatus", consumer)
    status = F.when(hit, F.col("ProducerStatus") + F.lit(consumer)).otherwise(F.col("ProducerStatus"))
    return changes.join(measured(sent), F.col("ID") == F.col("__id"), "left").select(
        *[status.cast("int").alias(c) if c == "ProducerStatus" else c for c in changes.columns]
    )


def purge(changes: DataFrame, complete: Column | int) -> DataFrame:
    """Drop rows every consumer has taken: their status equals the sum of the distinct consumers."""
    return changes.where(F.col("ProducerStatus") != complete)


def reinitialise(changes: DataFrame) -> DataFrame:
    """A full re-initialise forgets all earlier changes: rows at or after the newest initial action of their type.

    Types never re-initialised keep all their rows.
    """
    cut = (
        changes.where(F.col("Action") == fixed.ACTION_INITIAL)
        .groupBy(F.col("item_type").alias("__type"))
        .agg(F.max("InsertTime").alias("__cut"))
    )
    return (
        changes.join(measured(cut), F.col("item_type") == F.col("__type"), "left")
        .where((F.col("InsertTime") >= F.col("__cut")) | F.col("__cut").isNull())
        .select(*changes.columns)
    )


def types_in_order(types: DataFrame, column: str = "item_type") -> DataFrame:
    """Distinct types with their rank: Language first, then by name."""
    return types.select(column).distinct().select(
        column, F.when(F.lower(column) == "language", 0).otherwise(1).alias("rank")
    ).orderBy("rank", column)
