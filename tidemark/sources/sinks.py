"""Where documents and notices go. The writer is a function, so another connector can take its place.

Document sets are written as a log: every write appends its documents with a rising number, and the newest write of a
document's id is the document. A write so costs what it brings, whatever the set already holds; ``compact`` folds a log
into a new folder.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import document_set

Writer = Callable[[DataFrame, str], None]
# Number of the write that a row came with, and whether it took the document away.
WRITE = "_WriteNr"
GONE = "_Deleted"


def parquet_writer(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("document_set").parquet(path)


def json_writer(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("document_set").json(path)


def route_documents(docs: DataFrame, per_language: bool = True, searchable: bool = False) -> DataFrame:
    """Add the target set and the document id: ID in per-language sets, ID_language in a common set."""
    if per_language:
        target = document_set("item_type", "LanguageID", searchable)
        doc_id = F.col("ID").cast("string")
    else:
        target = F.concat_ws("_", F.lit("export"), F.lower(F.trim("item_type")))
        doc_id = F.concat_ws("_", "ID", "LanguageID")
    return docs.select("*", target.alias("document_set"), doc_id.alias("document_id"))


def write_documents(
    docs: DataFrame, path: str, writer: Writer = parquet_writer, number: int | None = None, deleted: bool = False, **routing
) -> None:
    """Insert or replace every document in its set (``deleted``: take it out); AQE splits the rows of a big set.

    ``number`` orders the writes of one folder (the clock by default); the same write repeated changes nothing.
    """
    routed = route_documents(docs, **routing)
    marked = routed.withColumns({WRITE: F.lit(time.time_ns() if number is None else number), GONE: F.lit(deleted)})
    writer(marked.hint("rebalance", "document_set"), path)


def current(log: DataFrame) -> DataFrame:
    """The documents of a log: of each id in each set the newest write, unless it is a deletion."""
    rest = [c for c in log.columns if c not in ("document_set", "document_id", WRITE)]
    newest = log.groupBy("document_set", "document_id").agg(F.max_by(F.struct(*rest), F.struct(WRITE)).alias("__last"))
    kept = newest.where(~F.col(f"__last.{GONE}"))
    return kept.select("document_set", "document_id", *[F.col(f"__last.{c}").alias(c) for c in rest if c != GONE])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents that ``write_documents`` has put below ``path`` as Parquet."""
    return current(spark.read.option("mergeSchema", "true").parquet(path))


def compact(spark: SparkSession, path: str, target: str) -> None:
    """The current documents as a log of one write in a new folder."""
    rows = read_documents(spark, path).withColumns({WRITE: F.lit(0).cast("bigint"), GONE: F.lit(False)})
    parquet_writer(rows.hint("rebalance", "document_set"), target)
