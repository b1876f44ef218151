"""Exact deduplication with a heavy-hitter split, in DataFrame functions only.

Texts are equal when identical after each run of white space became one space; null counts as the empty text, so null,
empty and all-blank-free texts follow the same rule (a text of blanks only becomes one space, not the empty text).
Equality is judged by the SHA-256 of the normalised text.

1. Digests are written once; Misra-Gries counters (the frequent-items sketch of ``approx_top_k``) run map-side over
   slices of the table and name every digest frequent enough to matter. An item above the share of all rows is above
   it in at least one slice.
2. The named digests are counted exactly, map-side combined. Those that really are frequent are the verified winners:
   at most ``rows / HOT_ROWS`` of them and never more than ``MAX_HOT``, so they can be broadcast.
3. Rows of winners are settled where they lie, without a shuffle; the remaining digests, none of which is hot, are
   shuffled and grouped as usual.

Defined cases: a null id never wins over an id; of rows with equal text and equal id one stays; the empty table gives
the empty result; other columns, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, free_name, whole_text
from tidemark.session import cut_lineage

# Counters of one Misra-Gries summary (a power of two) and digests reported by each.
COUNTERS = 4096
REPORTED = 512
# Partitions whose rows share one summary, and slices there are at most.
SLICES = 64
# A digest is settled by broadcast from this many rows on, and only the most frequent MAX_HOT are: 72 bytes each.
HOT_ROWS = 64
MAX_HOT = 20_000


def digest(text_column: str = "text"):
    """SHA-256 of the normalised text, lowercase hex."""
    return F.sha2(F.regexp_replace(whole_text(text_column), SPACE, " "), 256)


def frequent(digests: DataFrame, column: str, hot_rows: int = HOT_ROWS, max_hot: int = MAX_HOT) -> DataFrame:
    """Digests that Misra-Gries counters name: a superset of the frequent ones, not yet verified."""
    sliced = digests.select(F.col(column), F.pmod(F.spark_partition_id(), F.lit(SLICES)).alias("__slice"))
    summary = sliced.groupBy("__slice").agg(F.expr(f"approx_top_k({column}, {REPORTED}, {COUNTERS})").alias("__top"))
    named = summary.select(F.explode("__top").alias("__x")).where(F.col("__x.count") > 1)
    return named.groupBy(F.col("__x.item").alias(column)).agg(F.sum("__x.count").alias("__estimate")).where(
        F.col("__estimate") >= hot_rows // 2
    ).orderBy(F.desc("__estimate"), column).limit(max_hot).select(column)


def settle(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    hot_rows: int = HOT_ROWS,
    max_hot: int = MAX_HOT,
) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    digests = cut_lineage(
        docs.select(
            F.col(id_column).alias("__id"), digest(text_column).alias("__sha"), F.monotonically_increasing_id().alias("__row")
        )
    )
    rank = F.struct(F.col("__id").isNull(), "__id", "__row")
    winners = cut_lineage(
        digests.join(F.broadcast(frequent(digests, "__sha", hot_rows, max_hot)), "__sha")
        .groupBy("__sha")
        .agg(F.count(F.lit(1)).alias("__size"), F.min(rank).alias("__first"))
        .where(F.col("__size") >= hot_rows)
    )
    hot = digests.join(F.broadcast(winners), "__sha")
    rest = digests.join(F.broadcast(winners.select("__sha")), "__sha", "left_anti")
    same = Window.partitionBy("__sha")
    cold = rest.select(
        "__sha",
        "__id",
        "__row",
        F.count(F.lit(1)).over(same).alias("__size"),
        F.min(rank).over(same).alias("__first"),
    )
    return hot.select(*cold.columns).unionByName(cold).select(
        F.col("__id").alias(id_column),
        F.col("__first").getField("__id").alias("keep_id"),
        F.col("__size").cast("bigint").alias("group_size"),
        (F.col("__first").getField("__row") == F.col("__row")).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    hot_rows: int = HOT_ROWS,
    max_hot: int = MAX_HOT,
) -> DataFrame:
    """The rows of ``docs`` that stay, whole and with their own columns.

    Rows of a verified winner leave map-side, all but those with the winning id; what remains meets by digest, limited
    to one row per digest and task before the shuffle.
    """
    sha, order, hot, first = (free_name(docs, n) for n in ("__sha", "__order", "__hot", "__first"))
    keyed = docs.withColumn(sha, digest(text_column))
    digests = cut_lineage(keyed.select(F.col(sha).alias("__sha"), F.col(id_column).alias("__id")))
    winners = cut_lineage(
        digests.join(F.broadcast(frequent(digests, "__sha", hot_rows, max_hot)), "__sha")
        .groupBy("__sha")
        .agg(F.count(F.lit(1)).alias("__size"), F.min("__id").alias("__first"))
        .where(F.col("__size") >= hot_rows)
        .select(F.col("__sha").alias(hot), F.col("__first").alias(first))
    )
    marked = keyed.join(F.broadcast(winners), F.col(sha) == F.col(hot), "left")
    left = marked.where(F.col(hot).isNull() | F.col(id_column).eqNullSafe(F.col(first))).select(*keyed.columns)
    nth = Window.partitionBy(sha).orderBy(F.col(id_column).asc_nulls_last())
    return left.withColumn(order, F.row_number().over(nth)).where(F.col(order) == 1).select(*docs.columns)
