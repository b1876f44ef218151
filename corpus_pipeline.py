"""A training corpus from raw documents, stage by stage: toxic texts, exact copies and near copies leave, sources are
mixed to target weights, and what is left is packed into sequences.

Every stage reads all that its predecessor kept, and is written and read again before the next. Kept rows keep all
their columns; the mix repeats a document as often as it takes it. Of rows that are alike in every column each is a row
of its own until exact deduplication, which keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact, mixing, packing, simhash, toxicity
from tidemark.llm.common import remainder, table
from tidemark.llm.queries import tokenizer_path
from tidemark.session import configure, shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated score is 0.5 or more go; labels of the held-out fifth are not learnt from."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 5) != 0)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the row with the least id stays."""
    return exact.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose fingerprints of three-word shingles are linked by two bits or fewer, the row with the least id stays."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the weighted queue takes them, each as often as it is taken."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents with their sequence and place."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

# Neighbour search, fingerprints and packing are beyond SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
