"""Coalescing change notices on a live stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import fixed
from tidemark.operators.notices import in_lots, lot_sizes, sent
from tidemark.operators.ordered import HOT_ROWS
from tidemark.session import cut_lineage
from tidemark.sources.store import complete, dropped, listed

NOTICE_COLUMNS = ["notice_key", "at_ms", "event_id", "Action"]


def session_notices(
    notices: DataFrame, keys: list[str], at: str, late: str, quiet: str = "5 seconds"
) -> DataFrame:
    """Number of notices a quiet-time session gives, per key; combines on the map side.

    ``late`` is how long a stream waits for changes of the past: a change that comes later than that is dropped, so it is
    the caller's to choose. On a batch nothing is late.

    A session of n changes flushes n div 100 full lots as mass notices, and the rest as one mass notice or, up to
    three, one by one.
    """
    size = F.col("pending")
    rest = size % fixed.NOTICE_FLUSH
    return (
        notices.withWatermark(at, late)
        .groupBy(*keys, F.session_window(at, quiet).alias("session"))
        .agg(F.count(F.lit(1)).alias("pending"))
        .select(
            *keys,
            F.col("session.start").alias("session_start"),
            "pending",
            (F.floor(size / fixed.NOTICE_FLUSH) + F.when(rest > fixed.NOTICE_MASS_ABOVE, 1).otherwise(0)).alias(
                "mass_notices"
            ),
            F.when(rest > fixed.NOTICE_MASS_ABOVE, 0).otherwise(rest).alias("single_notices"),
        )
    )


@dataclass(frozen=True)
class NoticeSink:
    """Where live notices go, and what is still pending: below one shared folder, by batch and item type."""

    spark: SparkSession
    path: str
    quiet_ms: int = fixed.NOTICE_QUIET_MS
    flush: int = fixed.NOTICE_FLUSH
    hot_rows: int = HOT_ROWS

    @property
    def notices(self) -> str:
        return f"{self.path}/notices"

    def _pending(self, batch_id: int) -> str:
        return f"{self.path}/pending/batch={batch_id}"

    def pending(self, batch_id: int) -> DataFrame | None:
        """What the batches before this one have left unsent."""
        numbers = [int(n.removeprefix("batch=")) for n in listed(self.spark, f"{self.path}/pending")]
        done = [n for n in numbers if n < batch_id and complete(self.spark, self._pending(n))]
        return self.spark.read.parquet(self._pending(max(done))) if done else None

    def forget(self, batch_id: int) -> None:
        """Drop what was pending before the batch before this one: neither can come again."""
        for name in listed(self.spark, f"{self.path}/pending"):
            if int(name.removeprefix("batch=")) < batch_id - 1:
                dropped(self.spark, f"{self.path}/pending/{name}")


def coalesce_batch(sink: NoticeSink, batch: DataFrame, batch_id: int, close: bool = False) -> None:
    """Send the lots of a micro-batch that are full or have been quiet, and keep the rest: at most 99 changes per key.

    ``batch``: notice_key, at_ms, event_id, Action; rows without a key only tell the time. Time is the newest there is; with
    ``close`` it is over, and everything is sent. Gaps and counts run as in a batch, in chunks of a hot key, over the
    batch's changes and the pending ones, so one type that has all changes runs in as many tasks as it has chunks. A lot that
    waits begins at a multiple of a hundred of its session, so counting goes on from it. A batch that comes again finds
    what was pending before it and writes the same files.
    """
    rows = cut_lineage(batch.select(*NOTICE_COLUMNS))
    before = sink.pending(batch_id)
    now = rows.agg(F.max("at_ms")).first()[0]
    changes = rows.where(F.col("notice_key").isNotNull())
    if before is not None:
        changes = changes.unionByName(before)
    key = ["notice_key"]
    lots = cut_lineage(in_lots(changes, key, "at_ms", ["event_id"], None, sink.quiet_ms, sink.flush, sink.hot_rows))
    sizes = cut_lineage(lot_sizes(lots, key, "at_ms"))
    # A batch that tells no time makes nothing quiet.
    quiet = F.lit(False) if now is None else F.lit(now) - F.col("last_ms") > sink.quiet_ms
    waiting = (F.col("pending") < sink.flush) & ~quiet & F.lit(not close)
    group = ["notice_key", "__session", "__lot"]
    closed = sizes.where(~waiting)
    out = sent(lots.join(closed.select(*group), group, "left_semi"), closed, key, "at_ms")
    out.write.mode("overwrite").partitionBy("notice_key").parquet(f"{sink.notices}/batch={batch_id}")
    left = lots.join(sizes.where(waiting).select(*group), group, "left_semi").select(*NOTICE_COLUMNS)
    left.write.mode("overwrite").parquet(sink._pending(batch_id))
    sink.forget(batch_id)


def coalesce_stream(notices: DataFrame, sink: NoticeSink, heartbeat: int | None = 1) -> StreamingQuery:
    """Run a stream of notices into the sink. ``heartbeat`` (ticks per second) lets time go on while nothing comes, so that a
    quiet lot is sent; without it time is that of the changes, and the stream takes what there is and ends."""
    stream = notices.select(*NOTICE_COLUMNS)
    if heartbeat:
        types = dict(stream.dtypes)
        ticks = sink.spark.readStream.format("rate").option("rowsPerSecond", heartbeat).load().select(
            F.lit(None).cast(types["notice_key"]).alias("notice_key"), F.unix_millis("timestamp").alias("at_ms"),
            F.lit(None).cast(types["event_id"]).alias("event_id"), F.lit(None).cast(types["Action"]).alias("Action"),
        )
        stream = stream.unionByName(ticks)
    writer = stream.writeStream.foreachBatch(lambda batch, batch_id: coalesce_batch(sink, batch, batch_id))
    writer = writer.option("checkpointLocation", f"{sink.path}/checkpoint")
    return (writer if heartbeat else writer.trigger(availableNow=True)).start()


def read_notices(sink: NoticeSink) -> DataFrame:
    """All notices sent so far."""
    return sink.spark.read.parquet(sink.notices).drop("batch")
