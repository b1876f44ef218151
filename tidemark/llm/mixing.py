"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, served up to ``rounds`` times over. A document's virtual
finish time is the words of its source up to and including it, divided by the source's weight. The mix is the start of
the global order by finish time, cut where the budget (the words of the whole input) is spent. Sources that run dry
leave their share to the others, by weight, which is what the stated targets do.

The order is shuffled by a hash of the id, so reruns agree. Nothing is ordered whole: cumulative words come from a
range partitioning with one running sum inside each partition and one offset per (source, partition), so a source with
a third of all rows is split like any other.

Defined cases: null text has size 0; documents of size 0 are taken whenever their turn comes and cost nothing
(``taken`` is 0); a null source is a source of its own, last in order; an empty table, or one without words, gives
target 0; repeated rows count as often as they stand there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import CHUNK_ROWS, WORD, free_name, whole_text, with_row_key
from tidemark.session import cut_lineage

WEIGHTS = (5, 2, 1)
ROUNDS = 3


def words(text_column: str = "text") -> Column:
    """Number of words of the text."""
    return F.regexp_count(whole_text(text_column), F.lit(WORD)).cast("bigint")


def shuffle_key(id_column: str = "doc_id") -> Column:
    """Where a document stands in its source's queue: a hash of its id."""
    return F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, rounds: int = ROUNDS) -> DataFrame:
    """Per source: ``source_size``, ``weight`` and ``target``, of a frame with ``source`` and ``size``.

    One row per source is all that is windowed. Sources are filled in the order in which they would run dry; from the
    first that does not, everything left is shared by weight.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = per_source.select(
        "*", F.element_at(cycle, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")).alias("weight")
    )
    dry = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = dry.rowsBetween(Window.unboundedPreceding, -1)
    onward = dry.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = ranked.select(
        "*",
        (
            (F.sum("source_size").over(everything) - rounds * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
            / F.sum("weight").over(onward)
        ).alias("__level"),
    ).withColumn("__fits", F.col("__level") * F.col("weight") <= rounds * F.col("source_size"))
    water = level.withColumn("__water", F.max(F.when(F.col("__fits"), F.col("__level"))).over(everything))
    return water.select(
        "source",
        "source_size",
        "weight",
        F.least(F.col("__water") * F.col("weight"), (rounds * F.col("source_size")).cast("double")).alias("target"),
    )


def running_sum(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str, chunk_rows: int) -> DataFrame:
    """``name``: the sum of ``value`` up to each row along ``order`` within ``keys`` (none: over everything)."""
    parts = max(1, -(-rows.count() // chunk_rows))
    ranged = cut_lineage(rows.repartitionByRange(parts, *keys, *order).withColumn("__part", F.spark_partition_id()))
    inside = Window.partitionBy("__part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("__part", *keys).agg(F.sum(value).alias("__sum")).select(
        "__part", *keys, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before")
    )
    local = ranged.withColumn("__local", F.sum(value).over(inside))
    return local.join(offsets, ["__part", *keys]).select(
        *rows.columns, (F.col("__before") + F.col("__local")).alias(name)
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    rounds: int = ROUNDS,
    chunk_rows: int = CHUNK_ROWS,
    shuffle_column: str | None = None,
) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target``, ``taken`` and ``times`` (rounds it is in).

    The queue's order is a hash of ``shuffle_column``, by default the id.
    """
    sized = cut_lineage(
        docs.select(
            F.col(id_column).alias("__id"),
            F.col(source_column).cast("string").alias("source"),
            words(text_column).alias("size"),
            shuffle_key(shuffle_column or id_column).alias("__key"),
            F.monotonically_increasing_id().alias("__row"),
        )
    )
    shares = cut_lineage(
        targets(sized, weights, rounds).withColumn("__source", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    )
    queued = sized.join(shares, sized["source"].eqNullSafe(shares["source"])).select(
        "__id", "__row", "__key", "__source", "size", "source_size", "weight", "target"
    )
    queue = running_sum(queued, ["__source"], ["__key", "size", "__row"], "size", "__upto", chunk_rows)
    served = queue.withColumn("__round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1)))).withColumn(
        "__finish", (F.col("__round") * F.col("source_size") + F.col("__upto")) / F.col("weight")
    )
    ordered = running_sum(
        served, [], ["__finish", "__source", "__round", "__key", "size", "__row"], "size", "__spent", chunk_rows
    )
    budget = shares.agg(F.sum("source_size")).first()[0] or 0
    counted = ordered.where(F.col("__spent") <= budget).groupBy("__row").agg(F.count(F.lit(1)).alias("__times"))
    return queued.join(counted, "__row", "left").select(
        F.col("__id").alias(id_column),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.coalesce("__times", F.lit(0))).cast("bigint").alias("taken"),
        F.coalesce("__times", F.lit(0)).cast("int").alias("times"),
    )


def mixed(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as the mix takes it (rows of size 0 as often as their turn comes)."""
    key, times = free_name(docs, "__key"), free_name(docs, "__times")
    keyed = with_row_key(docs, id_column, key)
    taken = mix(keyed, key, text_column, source_column, weights, rounds, shuffle_column=id_column).where(F.col("times") > 0)
    joined = keyed.join(taken.select(F.col(key), F.col("times").alias(times)), key)
    repeated = joined.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return repeated.select(*docs.columns)
