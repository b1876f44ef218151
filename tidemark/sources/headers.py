"""The header dictionary: which fields an item type has, their types, and which are searchable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import comma_list

# --- fixed values: sections of a header -----------------------------------------------------------------
HEADER_SCHEMA = (
    "StandardFields map<string,string>, CustomFields map<string,string>, SearchableFields map<string,string>, "
    "SearchableReferences array<string>, SearchableSubtables array<string>, LanguageIds string"
)


def read_headers(headers: DataFrame, item_types: list[str] | None = None, kind: str | None = None) -> DataFrame:
    """(header_key, item_type, type, header) of the asked types; names compare without case."""
    rows = headers
    if item_types is not None:
        rows = rows.where(F.lower("ItemType").isin([t.lower() for t in item_types]))
    if kind is not None:
        rows = rows.where(F.lower("Type") == kind.lower())
    key = F.when(F.lower("Type") == "item", F.lower("ItemType")).otherwise(
        F.lower(F.concat_ws("_", "ItemType", "Type"))
    )
    return rows.select(
        key.alias("header_key"),
        F.col("ItemType").alias("item_type"),
        F.col("Type").alias("type"),
        F.from_json("Data", HEADER_SCHEMA).alias("header"),
    )


def fields_of_type(section: Column, cs_type: str) -> Column:
    """Names in a header section whose type is ``cs_type`` (such as html)."""
    return F.map_keys(F.map_filter(section, lambda _, v: v == cs_type))


def searchable_and_standard(header: Column) -> Column:
    """Union of searchable and standard field names."""
    return F.array_union(F.map_keys(header["SearchableFields"]), F.map_keys(header["StandardFields"]))


def language_ids(header: Column) -> Column:
    """Language ids the header of the language type lists."""
    return F.transform(comma_list(header["LanguageIds"]), lambda i: i.cast("bigint"))
