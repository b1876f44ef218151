"""Who listens to which item types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizes import measured

KEY = ["SubscriberName", "ItemType"]


def subscribed_types(subscriptions: DataFrame, condition: Column) -> DataFrame:
    """Distinct item types of a producer or a subscriber."""
    return subscriptions.where(condition).select("ItemType").distinct()


def consumer_masks(subscriptions: DataFrame) -> DataFrame:
    """Sum of the distinct producer ids per item type."""
    return subscriptions.groupBy("ItemType").agg(F.sum_distinct("ProducerID").alias("mask"))


def consumer_mask(subscriptions: DataFrame, item_type: str) -> DataFrame:
    """One row; -1 when nobody listens."""
    return subscriptions.where(F.col("ItemType") == item_type).agg(
        F.coalesce(F.sum_distinct("ProducerID"), F.lit(-1)).alias("mask")
    )


def removed_types(subscriptions: DataFrame, wanted: DataFrame) -> DataFrame:
    """Subscribed pairs the subscriber no longer asks for."""
    return subscriptions.select(*KEY).join(wanted.select(*KEY).distinct(), KEY, "left_anti")


def upsert(subscriptions: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert new pairs. A pair that is there keeps its producer id, as the duplicate-key rule only touches keys."""
    new = incoming.groupBy(*KEY).agg(F.min("ProducerID").alias("ProducerID"))
    return subscriptions.unionByName(new.join(subscriptions, KEY, "left_anti"))


def remove(subscriptions: DataFrame, leaving: DataFrame) -> DataFrame:
    """Delete pairs."""
    return subscriptions.join(leaving, leaving.columns, "left_anti")


def unheard(rows: DataFrame, subscriptions: DataFrame, column: str = "item_type") -> DataFrame:
    """Rows of item types nobody listens to; their logs can go."""
    heard = measured(subscriptions.select(F.col("ItemType").alias(column)).distinct())
    return rows.join(heard, column, "left_anti").select(*rows.columns)
