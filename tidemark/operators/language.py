"""Language rules of the catalogue: independent values win, language 0 is copied to every language."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.gather import PART_ROWS, gather

INDEPENDENT = 0


def overlay(items: DataFrame, keys: Sequence[str] = ("ID",), fields: str = "fields") -> DataFrame:
    """Lay the language-independent row of an item over each of its language rows, then drop it."""
    independent = items.where(F.col("LanguageID") == INDEPENDENT).select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        F.map_filter(fields, lambda k, _: ~k.isin("LanguageID", "LanguageShortName")).alias("__independent"),
    )
    match = [F.col(k) == F.col(f"__{k}") for k in keys]
    own = F.map_filter(fields, lambda k, _: ~F.map_contains_key(F.col("__independent"), k))
    merged = F.when(F.col("__independent").isNull(), F.col(fields)).otherwise(F.map_concat(own, "__independent"))
    return (
        items.where(F.col("LanguageID") != INDEPENDENT)
        .join(independent, match, "left")
        .select(*[merged.alias(c) if c == fields else c for c in items.columns])
    )


def fan_out(rows: DataFrame, item_languages: DataFrame, owner: str = "ItemID") -> DataFrame:
    """Copy rows of language 0 to every language their item has; others stay.

    ``item_languages`` holds distinct (ID, LanguageID) of the items.
    """
    languages = item_languages.groupBy(F.col("ID").alias("__id")).agg(
        F.collect_set("LanguageID").alias("__languages")
    )
    target = F.when(F.col("LanguageID") == INDEPENDENT, F.col("__languages")).otherwise(F.array("LanguageID"))
    return (
        rows.join(languages, F.col(owner) == F.col("__id"), "left")
        .withColumn("LanguageID", F.explode(target))
        .select(*rows.columns)
    )


def bundle(items: DataFrame, payload: Column, keys: Sequence[str] = ("ID",)) -> DataFrame:
    """One row per item: language → payload. The number of languages bounds the map."""
    return items.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("LanguageID").alias("k"), payload.alias("v")))).alias("languages")
    )


def pivot_records(messages: DataFrame, keys: Sequence[str] = ("ID",)) -> DataFrame:
    """Message rows by language; no language means 1. States of a workflow become rows ``States_<id>``.

    Needs ``rows``, an array of (fields, states) of one message: fields is a map, states an array of maps.
    """
    entry = messages.select(*keys, F.explode("rows").alias("row"))
    own = entry.select(
        *keys,
        F.coalesce(F.col("row.fields")["LanguageID"], F.lit("1")).alias("row_key"),
        F.map_filter("row.fields", lambda k, _: k != "_States").alias("fields"),
    )
    states = entry.select(*keys, F.explode("row.states").alias("state")).select(
        *keys, F.concat(F.lit("States_"), F.col("state")["StateID"]).alias("row_key"), F.col("state").alias("fields")
    )
    return own.unionByName(states)


def group_rows(rows: DataFrame, item: Column, order: Sequence[str], owner: str = "ItemID",
               limit: int = PART_ROWS) -> DataFrame:
    """Rows of an item by language and attribute, in parts of at most ``limit`` rows."""
    return gather(rows, [owner, "LanguageID", "AttributeID"], item, order, limit=limit)


def resolve_language(languages: DataFrame, short_name: str | None = None) -> Column:
    """Id of a language as a scalar subquery: by short name, or the default one."""
    wanted = F.col("IsDefault") == 1 if short_name is None else F.col("ShortName") == short_name
    return languages.where(wanted).agg(F.max("ID").alias("id")).scalar()


