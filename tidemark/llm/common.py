"""Helpers shared by the operators: tables, texts, row keys and intermediate tables."""

from __future__ import annotations

import ctypes
import sys

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

# White space of every text rule here: space, tab, newline, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Rows of one chunk of an ordered key; a chunk is what one task orders at a time.
CHUNK_ROWS = 1 << 17


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder, read by Spark (the folder may be in any store Spark reads)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text as a string, null counting as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def remainder(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))), F.lit(modulus))


def release_memory() -> None:
    """Give the system back what this process has freed; the allocators keep it otherwise, for as long as the driver runs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim:
        trim(0)


def ordered_position(df: DataFrame, keys: list[str], name: str, rows_per_chunk: int = CHUNK_ROWS) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... along ``keys``, at any size.

    Rows are range-partitioned and written with the number of their partition; only one count per partition is
    windowed to give each its offset, so no task orders more than a partition.
    """
    parts = max(1, -(-df.count() // rows_per_chunk))
    ranged = df.repartitionByRange(parts, *keys).withColumn("__part", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    local = ranged.withColumn("__local", F.row_number().over(Window.partitionBy("__part").orderBy(*keys)))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("__part").count().select(
        F.col("__part"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before")
    )
    return local.join(offsets, "__part").select(
        *df.columns, (F.col("__before") + F.col("__local") - 1).cast("bigint").alias(name)
    )


def with_row_key(df: DataFrame, id_column: str, name: str) -> DataFrame:
    """``df`` with ``name``: a long that is unique per row, never null and rises with ``id_column`` (nulls last).

    Where the ids are longs, unique and not null they are the key. Otherwise the rows are written once with their
    position by id, then by text hash; rows equal in both are interchangeable.
    """
    ids = df.select(F.col(id_column).cast("bigint").alias("__id"))
    broken = ids.groupBy("__id").count().where(F.col("__id").isNull() | (F.col("count") > 1))
    if broken.isEmpty():
        return df.withColumn(name, F.col(id_column).cast("bigint"))
    tied = df.select(
        "*",
        F.col(id_column).isNull().alias("__null"),
        F.xxhash64(*[F.col(c) for c in df.columns]).alias("__hash"),
    )
    placed = cut_lineage(ordered_position(tied, ["__null", id_column, "__hash"], name))
    return placed.drop("__null", "__hash")


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``cut_lineage`` wrote, once all that was built on them is written itself.

    The shuffle files of the jobs before are garbage by then, but Spark only drops them when the driver's collector
    comes round to their owners; it is asked to, so that a long job doesn't keep every shuffle it ever made.
    """
    for df in tables:
        spark = df.sparkSession
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        tables[0].sparkSession._jvm.System.gc()
