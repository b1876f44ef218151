"""The change feed run as a stream, in several micro-batches with carried state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import feed
from tidemark.plans.fixtures import Fixtures
from tidemark.plans.registry import REGISTRY, query
from tidemark.session import shared_dir
from tidemark.sources.changes import stream_changes
from tidemark.streaming.apply import FeedState, apply_batch, filter_batch, start
from tidemark.streaming.notices import NoticeSink, coalesce_batch, coalesce_stream, read_notices

SLICES = 3
COLUMNS = ["seq", "event_id", "item_type", "type", "ID", "Action", "InsertTime", "Message"]


def feed_in_slices(fx: Fixtures, step) -> FeedState:
    """Let the log arrive in slices of its arrival order; each restart of the stream takes up the next one."""
    root = shared_dir(fx.spark, "feed")
    state = FeedState(fx.spark, f"{root}/state")
    changes = fx.changes.select(*COLUMNS)
    last = changes.agg(F.max("seq")).first()[0]
    schema = changes.schema
    for i in range(SLICES):
        low, high = last * i // SLICES, last * (i + 1) // SLICES
        arrived = changes.where((F.col("seq") > (low if i else -1)) & (F.col("seq") <= high))
        arrived.write.mode("append").parquet(f"{root}/inbox")
        stream = stream_changes(fx.spark, f"{root}/inbox", schema=schema)
        start(stream, state, step).awaitTermination()
    return state


@query("stream_stale_filter", "SELECT event_id, verdict FROM {fx_judged}")
def stream_stale_filter(fx: Fixtures) -> DataFrame:
    state = feed_in_slices(fx, filter_batch)
    return fx.spark.read.parquet(state.accepted).select("event_id", "verdict")


@query("stream_apply", "SELECT * FROM {fx_state}")
def stream_apply(fx: Fixtures) -> DataFrame:
    return feed_in_slices(fx, apply_batch).items.read()


@query("notify_stream", REGISTRY["notify_coalesce"].oracle)
def notify_stream(fx: Fixtures) -> DataFrame:
    """The notices of the log, sent live from three arrivals in order of time."""
    root = shared_dir(fx.spark, "notices")
    at_ms = F.floor(F.col("InsertTime") / 1000).cast("bigint")
    changes = fx.changes.select(F.col("item_type").alias("notice_key"), at_ms.alias("at_ms"), "event_id", "Action")
    low, high = changes.agg(F.min("at_ms"), F.max("at_ms")).first()
    sink = NoticeSink(fx.spark, f"{root}/sink", quiet_ms=feed.QUIET_MS)
    for i in range(SLICES):
        start_ms, end_ms = (low + (high + 1 - low) * k // SLICES for k in (i, i + 1))
        changes.where((F.col("at_ms") >= start_ms) & (F.col("at_ms") < end_ms)).write.mode("append").parquet(f"{root}/inbox")
        stream = stream_changes(fx.spark, f"{root}/inbox", schema=changes.schema)
        coalesce_stream(stream, sink, heartbeat=None).awaitTermination()
    # The log is over: what is still pending goes out.
    coalesce_batch(sink, changes.limit(0), SLICES, close=True)
    return read_notices(sink).withColumnRenamed("notice_key", "item_type")
