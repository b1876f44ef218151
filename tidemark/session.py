"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every plan relies on. Broadcast joins are never hinted: Catalyst and AQE pick them
# from measured sizes (spark.sql.autoBroadcastJoinThreshold), and AQE splits skewed sort-merge partitions.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A task that groups what it reads holds the groups of one split: smaller ones keep that memory small on large files.
    "spark.sql.files.maxPartitionBytes": "32m",
    # Shuffles are cut finely and put together to so many bytes, so a task's share doesn't grow with the tables.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Rows that come sorted by what they are grouped by are grouped as they come.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # Rows brought together by owner stay there for joins on the owner and more.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app: str = "tidemark", **conf: str) -> SparkSession:
    """Build a session; cluster sizing stays with spark-submit, only engine settings are fixed here."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the folder. Only a local master may fall back to a temporary folder,
    because there the driver and the executors share one disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


# Files of ids: most values are few or new, so dictionaries take more room than they save.
IDS = {"compression": "zstd", "parquet.enable.dictionary": "false"}


def cut_lineage(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so lost executors never replay the loop before it."""
    path = shared_dir(df.sparkSession, "cut")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_by_key(df: DataFrame, keys: Sequence[str], shares: int) -> DataFrame:
    """Like ``cut_lineage``, in buckets by ``keys``: what is read back lies where ``repartition(shares, *keys)`` brings other
    rows, so it meets them without a shuffle. The catalog holds the table only until it is read."""
    session, name = df.sparkSession, f"tidemark_cut_{uuid.uuid4().hex}"
    df.write.bucketBy(shares, *keys).options(path=shared_dir(session, "cut"), **IDS).saveAsTable(name, format="parquet")
    stored = session.table(name)
    session.sql(f"DROP TABLE {name}")
    return stored
