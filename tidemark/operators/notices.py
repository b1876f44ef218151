"""Change notices, and when many of them become one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.maps import notice_language_part, notice_root_part
from tidemark.functions.text import id_list
from tidemark.operators.ordered import HOT_ROWS, Running, hot_keys, running


def payloads(changes: DataFrame) -> DataFrame:
    """Notice payload per item and language; actions other than update, delete and create give none.

    Needs Action, item_type, type and fields.
    """
    return changes.where(
        F.col("Action").isin(fixed.ACTION_UPDATE, fixed.ACTION_DELETE, fixed.ACTION_CREATE)
    ).withColumns(
        {
            "language_fields": notice_language_part("fields"),
            "root_fields": F.map_filter(notice_root_part("fields"), lambda k, _: k != "ClassMapping"),
            "classes": id_list(F.col("fields")["ClassMapping"]),
        }
    )


def in_lots(
    notices: DataFrame,
    keys: Sequence[str],
    at_ms: str,
    tie: Sequence[str],
    chunk: Column | None,
    quiet_ms: int = fixed.NOTICE_QUIET_MS,
    flush: int = fixed.NOTICE_FLUSH,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Notices with the lot they are sent in, per key: ``__session`` (its first time) and ``__lot`` (of ``flush`` pending
    ones each, numbered within the session). A session ends after ``quiet_ms`` without news.

    Keys are few and hot, so gaps and counts run in chunks of the time line: those of ``chunk``, or of positions.
    """
    order = [F.col(at_ms), *[F.col(c) for c in tie]]
    hot = hot_keys(notices, keys, hot_rows)
    numbered = running(
        notices, keys, order, chunk,
        Running("__previous", "max", F.col(at_ms), before=True),
        Running("__position", "count"),
        hot=hot, limit=hot_rows,
    )
    opens = F.col("__previous").isNull() | (F.col(at_ms) - F.col("__previous") > quiet_ms)
    sessions = running(
        numbered, keys, order, chunk,
        Running("__session", "max", F.when(opens, F.col(at_ms))),
        Running("__first", "max", F.when(opens, F.col("__position"))),
        hot=hot, limit=hot_rows,
    )
    lot = F.floor((F.col("__position") - F.col("__first")) / flush)
    return sessions.select(*notices.columns, "__session", lot.alias("__lot"))


def lot_sizes(lots: DataFrame, keys: Sequence[str], at_ms: str) -> DataFrame:
    """One row per lot: how many are pending in it, the first and the last time. Combines on the map side."""
    return lots.groupBy(*keys, "__session", "__lot").agg(
        F.count(F.lit(1)).alias("pending"), F.min(at_ms).alias("first_ms"), F.max(at_ms).alias("last_ms")
    )


def sent(lots: DataFrame, sizes: DataFrame, keys: Sequence[str], at_ms: str) -> DataFrame:
    """The notices of lots: a lot of more than three is one mass notice (type -1) with the number it stands for."""
    group = [*keys, "__session", "__lot"]
    mass = sizes.where(F.col("pending") > fixed.NOTICE_MASS_ABOVE).select(
        *keys, F.lit(fixed.NOTICE_MASS_TYPE).alias("notice_type"), "pending", "first_ms", "last_ms"
    )
    few = sizes.where(F.col("pending") <= fixed.NOTICE_MASS_ABOVE).select(*group)
    single = lots.join(few, group, "left_semi").select(
        *keys,
        F.col("Action").alias("notice_type"),
        F.lit(1).cast("bigint").alias("pending"),
        F.col(at_ms).alias("first_ms"),
        F.col(at_ms).alias("last_ms"),
    )
    return mass.unionByName(single)


def coalesced(
    notices: DataFrame,
    keys: Sequence[str],
    at_ms: str,
    tie: Sequence[str],
    chunk: Column | None,
    quiet_ms: int = fixed.NOTICE_QUIET_MS,
    flush: int = fixed.NOTICE_FLUSH,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Notices as sent, per key: a flush after ``quiet_ms`` without news or at ``flush`` pending ones."""
    lots = in_lots(notices, keys, at_ms, tie, chunk, quiet_ms, flush, hot_rows)
    return sent(lots, lot_sizes(lots, keys, at_ms), keys, at_ms)
