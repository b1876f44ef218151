"""The change feed as a stream: drop stale changes, keep the item store, survive redelivery.

Each micro-batch runs the batch operators on its rows and on those buckets of freshness state and item store that its keys
fall into, and rewrites these buckets only. Accepted changes are written under the batch's number. A redelivered batch finds
what it has finished and only puts it in place again: at-least-once delivery gives exactly-once results. A hot key inside a
batch is handled by the chunked operators; one stateful Python task per key would serialise it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.apply import latest, upsert_items
from tidemark.operators.feed import reinitialise
from tidemark.operators.freshness import ITEM_KEY, fold_state, judge, of_items
from tidemark.session import cut_lineage
from tidemark.sources.store import BucketStore, complete


@dataclass(frozen=True)
class FeedState:
    """Where a consumer of the feed keeps its books, all below one shared folder."""

    spark: SparkSession
    root: str
    # What identifies an item; with its type and kind among them, only items and file contents are stored.
    keys: tuple[str, ...] = ITEM_KEY

    @property
    def freshness(self) -> BucketStore:
        return BucketStore(self.spark, f"{self.root}/freshness", self.keys)

    @property
    def items(self) -> BucketStore:
        return BucketStore(self.spark, f"{self.root}/items", self.keys)

    @property
    def accepted(self) -> str:
        return f"{self.root}/accepted"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def filter_batch(state: FeedState, batch: DataFrame, batch_id: int | str) -> DataFrame:
    """Judge one micro-batch against the carried state, then move the state on."""
    path = f"{state.accepted}/batch={batch_id}"
    if not complete(state.spark, path):
        # Read once here; judging and folding go over the written rows.
        rows = cut_lineage(batch)
        known = state.freshness.read(state.freshness.touched(rows))
        judge(rows, keys=state.keys, state=known).write.mode("overwrite").parquet(path)
    judged = state.spark.read.parquet(path).drop("verdict")
    touched = state.freshness.touched(judged)
    state.freshness.replace(fold_state(judged, state.freshness.read(touched), state.keys), batch_id, touched)
    return state.spark.read.parquet(path)


def _stored(state: FeedState, judged: DataFrame) -> DataFrame:
    """Accepted changes that make items."""
    accepted = judged.where("verdict = 'valid'").drop("verdict")
    return accepted.where(of_items()) if {"item_type", "type"} <= set(state.keys) else accepted


def apply_batch(state: FeedState, batch: DataFrame, batch_id: int | str) -> None:
    """Filter one micro-batch and put its items into the store."""
    last = cut_lineage(latest(_stored(state, filter_batch(state, batch, batch_id)), state.keys))
    touched = state.items.touched(last)
    state.items.replace(upsert_items(state.items.read(touched), last, state.keys), batch_id, touched)


def rebuild(spark: SparkSession, root: str, changes: DataFrame, keys: tuple[str, ...] = ITEM_KEY) -> FeedState:
    """Start over in a new folder: forget what lies before each type's newest initial action, load the rest.

    The old folder stays as it is until readers have moved; a stream started on the result goes on from here.
    """
    state = FeedState(spark, root, keys)
    apply_batch(state, reinitialise(changes), "initial")
    return state


def start(
    changes: DataFrame,
    state: FeedState,
    step: Callable[[FeedState, DataFrame, int], object] = apply_batch,
    available_now: bool = True,
    every: str = "5 seconds",
) -> StreamingQuery:
    """Run ``step`` on every micro-batch of the streaming ``changes``."""
    writer = changes.writeStream.foreachBatch(lambda batch, batch_id: (step(state, batch, batch_id), None)[1])
    writer = writer.option("checkpointLocation", state.checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()
