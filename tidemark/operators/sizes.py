"""Broadcast only what has been counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a few narrow columns; more are joined by shuffle, where AQE splits skewed partitions.
BROADCAST_ROWS = 100_000


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """At most ``rows`` rows. The limit stops the count early on anything bigger."""
    return df.limit(rows + 1).count() <= rows


def measured(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if it is small.

    For joins on keys with few values (types, languages, workflows, class lists): shuffling the big side by such a
    key would put most rows into a handful of tasks.
    """
    return F.broadcast(df) if is_small(df, rows) else df


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores, for work on a row that costs far more than moving it: a compact file may be a single split."""
    session = df.sparkSession
    return df.repartition(max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions"))))
