"""Processing times out of log files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Log files as lines."""
    return spark.read.text(path)


def processing_times(lines: DataFrame) -> DataFrame:
    """(service, took_ms) of every success line of a known consumer."""
    consumer = F.regexp_extract("value", r"\[(\w+)\] " + fixed.LOG_SUCCESS, 1)
    names = F.create_map(*[F.lit(x) for pair in fixed.LOG_CONSUMERS.items() for x in pair])
    return lines.select(
        names[consumer].alias("service"),
        F.regexp_extract("value", r"Took\(ms\)\s*:?\s*(\d+)\s*$", 1).try_cast("bigint").alias("took_ms"),
    ).where(F.col("service").isNotNull() & F.col("took_ms").isNotNull())


def mean_times(times: DataFrame) -> DataFrame:
    """Integer mean per service."""
    return times.groupBy("service").agg(
        F.count(F.lit(1)).alias("n"), F.expr("sum(took_ms) div count(1)").alias("mean_ms")
    )
