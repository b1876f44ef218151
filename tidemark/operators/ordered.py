"""Running aggregates over ordered keys of any size.

A plain window puts every row of one key into one task. Keys are counted first (one narrow, map-side combined pass,
over hashes of the keys); only those above ``HOT_ROWS`` are cut into chunks of their order: rows are windowed inside (key, chunk), each chunk is
summarised by a map-side combined aggregate, the summaries (one row per chunk) are windowed per key, and the carried
value is joined back. No task ever holds more than one chunk of a hot key, and all other keys pay for a plain window.

Where the order is an arrival number a chunk is a span of that number. Any other order is cut by position: rows of hot
keys are range-partitioned along (key, order), whatever the values are, and a chunk is a range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.sizes import measured
from tidemark.session import cut_lineage

# Arrival positions per chunk. The widest (key, chunk) group is one chunk long whatever the key's share is.
CHUNK_WIDTH = 1 << 21
# Keys up to this many rows are windowed whole.
HOT_ROWS = 1 << 21
# Keys are counted in so many groups first.
KEY_BUCKETS = 1 << 16
# Ranges are cut from samples: as many more of them are made, so that the longest still is within the limit.
RANGES = 2


@dataclass(frozen=True)
class Running:
    """One running aggregate: ``kind`` is max, min, sum or count, over rows up to (and including) this one.

    ``before=True`` leaves the current row out.
    """

    name: str
    kind: str
    value: Column | None = None
    before: bool = False


def chunk_of(position: Column, width: int = CHUNK_WIDTH) -> Column:
    """Chunk number of a numeric arrival position."""
    return F.floor(position / F.lit(width)).cast("bigint")


def _aggregate(kind: str, value: Column | None) -> Column:
    if kind == "count":
        return F.count(F.lit(1))
    return {"max": F.max, "min": F.min, "sum": F.sum}[kind](value)


def _combine(kind: str, carried: Column, local: Column) -> Column:
    if kind == "max":
        return F.greatest(carried, local)
    if kind == "min":
        return F.least(carried, local)
    return F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))


def _windowed(rows: DataFrame, by: Sequence[str], order: Sequence[Column], aggregates, prefix: str) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(*order)
    included = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    excluded = window.rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        "*",
        *[
            _aggregate(a.kind, a.value).over(excluded if a.before else included).alias(f"{prefix}{a.name}")
            for a in aggregates
        ],
    )


def _named(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """Keys under names of their own, and the bucket they are counted in."""
    named = df.select(*[F.col(k).alias(f"__h_{k}") for k in keys])
    return named, F.pmod(F.xxhash64(*named.columns), F.lit(KEY_BUCKETS)).alias("__bucket")


def bucket_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows by hash of their key (__bucket, count), written out once: for ``hot_keys`` with several limits, or for sizes."""
    named, bucket = _named(df, keys)
    return cut_lineage(named.groupBy(bucket).count())


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """Keys with more than ``limit`` rows, written out once.

    Rows are counted by hash of the key first, so a task holds ``KEY_BUCKETS`` counts at most, however many keys it reads.
    Keys themselves are counted only where a bucket has more than ``limit`` rows. ``counts``: the ``bucket_counts`` of
    these rows, or of more.
    """
    named, bucket = _named(df, keys)
    many = (named.groupBy(bucket).count() if counts is None else counts).where(F.col("count") > limit).select("__bucket")
    full = cut_lineage(many) if counts is None else many
    if full.isEmpty():
        return named.limit(0)
    held = named.withColumn("__bucket", bucket).join(F.broadcast(full), "__bucket", "left_semi")
    return cut_lineage(held.groupBy(*named.columns).count().where(F.col("count") > limit).select(*named.columns))


def _hot_chunks(df: DataFrame, keys: Sequence[str], chunk: Column, hot: DataFrame | None) -> DataFrame | None:
    """Rows with ``__chunk``, which is NULL for keys that are not hot; None when no key is."""
    if not keys:
        return df.withColumn("__chunk", chunk)
    if hot.isEmpty():
        return None
    match = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"__h_{k}") for k in keys])
    flagged = df.join(measured(hot), match, "left")
    return flagged.select(*df.columns, F.when(F.col(f"__h_{keys[0]}").isNotNull(), chunk).alias("__chunk"))


def _carried(rows: DataFrame, keys: Sequence[str], aggregates: Sequence[Running]) -> DataFrame:
    """What the chunks before each chunk of a key add up to: one row per (key, chunk) that has any before it."""
    by_chunk = [*keys, "__chunk"]
    # A key-less order still summarises to one row per chunk, so its single window stays small.
    earlier = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*by_chunk).agg(*[_aggregate(a.kind, a.value).alias(f"__sum_{a.name}") for a in aggregates])
    return sums.select(
        *[F.col(c).alias(f"__k_{c}") for c in by_chunk],
        *[
            _aggregate("sum" if a.kind == "count" else a.kind, F.col(f"__sum_{a.name}")).over(earlier).alias(f"__carry_{a.name}")
            for a in aggregates
        ],
    ).where(reduce(lambda x, y: x | y, [F.col(f"__carry_{a.name}").isNotNull() for a in aggregates]))


def _with_carried(columns: Sequence[str], joined: DataFrame, aggregates: Sequence[Running]) -> DataFrame:
    return joined.select(
        *columns,
        *[_combine(a.kind, F.col(f"__carry_{a.name}"), F.col(f"__local_{a.name}")).alias(a.name) for a in aggregates],
    )


def _by_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], aggregates: Sequence[Running], limit: int, hot: DataFrame
) -> DataFrame:
    """Hot keys in chunks of at most ``limit`` rows, each a task of its own; the rest by a plain window."""
    if hot.isEmpty():
        return _windowed(df, keys, order, aggregates, "")
    few = measured(hot)
    match = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__h_{k}")) for k in keys])
    cold = _windowed(df.join(few, match, "left_anti"), keys, order, aggregates, "")
    many = cut_lineage(df.join(few, match, "left_semi"))
    parts = max(1, -(-RANGES * many.count() // max(1, limit)))
    ranged = many.repartitionByRange(parts, *[F.col(k) for k in keys], *order)
    # The number of a range is written down: a task that runs again must find its rows under the same number.
    chunked = cut_lineage(ranged.withColumn("__chunk", F.spark_partition_id()))
    by_chunk = [*keys, "__chunk"]
    local = _windowed(chunked.repartitionById(parts, F.col("__chunk")), by_chunk, order, aggregates, "__local_")
    carry = measured(_carried(chunked, keys, aggregates))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in by_chunk])
    done = _with_carried(df.columns, local.join(carry, same, "left"), aggregates)
    return cold.select(*df.columns, *[a.name for a in aggregates]).unionByName(done)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    chunk: Column | None,
    *aggregates: Running,
    limit: int = HOT_ROWS,
    hot: DataFrame | bool | None = None,
) -> DataFrame:
    """Add the running ``aggregates`` of each key. ``order`` must be total within a key.

    ``chunk`` is the span of an arrival number a row lies in: it must never decrease along ``order``, and keys and chunk
    must not be NULL. Without keys the order is global and always runs in chunks. ``chunk=None`` cuts hot keys by
    position instead, about ``limit`` rows a chunk; keys may be NULL then. ``hot`` passes the result of ``hot_keys``
    when several calls share their keys, or False where no key is hot.
    """
    if hot is False:
        return _windowed(df, keys, order, aggregates, "")
    if keys and hot is None:
        hot = hot_keys(df, keys, limit)
    if chunk is None:
        return _by_position(df, keys, order, aggregates, limit, hot)
    rows = _hot_chunks(df, keys, chunk, hot)
    if rows is None:
        return _windowed(df, keys, order, aggregates, "")
    by_chunk = [*keys, "__chunk"]
    local = _windowed(rows, by_chunk, order, aggregates, "__local_")
    carry = _carried(rows.where(F.col("__chunk").isNotNull()), keys, aggregates)
    # Plain equality: the join reuses the window's partitioning and order, and unchunked rows match nothing.
    match = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"__k_{c}") for c in by_chunk])
    return _with_carried(df.columns, local.join(carry, match, "left"), aggregates)
