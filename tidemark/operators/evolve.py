"""Schemas that grow and shrink with the attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed


def header_columns(headers: DataFrame) -> DataFrame:
    """(header_key, field, column_type) of every header: standard types as given, custom fields text, and the
    bookkeeping columns."""
    types = F.create_map(*[F.lit(x) for pair in fixed.HEADER_TYPES.items() for x in pair])
    books = F.array(
        *[F.struct(F.lit(c).alias("field"), F.lit("timestamp").alias("column_type")) for c in fixed.BOOKKEEPING_TIMES],
        F.struct(F.lit(fixed.BOOKKEEPING_FLAG).alias("field"), F.lit("int").alias("column_type")),
    )
    standard = F.transform(
        F.map_entries(F.coalesce("header.StandardFields", F.create_map().cast("map<string,string>"))),
        lambda e: F.struct(e["key"].alias("field"), F.coalesce(types[e["value"]], F.lit("string")).alias("column_type")),
    )
    custom = F.transform(
        F.map_keys(F.coalesce("header.CustomFields", F.create_map().cast("map<string,string>"))),
        lambda k: F.struct(k.alias("field"), F.lit("string").alias("column_type")),
    )
    return headers.select("header_key", F.inline(F.concat(standard, custom, books)))


def struct_type(columns: DataFrame) -> T.StructType:
    """Spark schema of one header (its columns are a bounded piece of metadata)."""
    fields = [(r["field"], r["column_type"]) for r in columns.select("field", "column_type").collect()]
    return T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in sorted(fields)])


def evolve(store: DataFrame, incoming: DataFrame, dropped: tuple[str, ...] = ()) -> DataFrame:
    """Store and incoming rows under their common schema: new columns appear, dropped ones go."""
    return store.unionByName(incoming, allowMissingColumns=True).drop(*dropped)


def lookup_table(items: DataFrame, field: str, item_type: str) -> DataFrame | None:
    """Narrow (LanguageID, field, ID) table without missing values; users have none for workflow and state."""
    if item_type == "User" and field in fixed.LOOKUP_SKIPPED_FOR_USER:
        return None
    return items.select("LanguageID", field, "ID").where(F.col(field).isNotNull())


def wide(items: DataFrame, attribute_ids: list[int]) -> DataFrame:
    """Wide-column view of a bounded list of attributes: one value and one formatted column each."""
    return items.select(
        *[c for c in items.columns if c != "attrs"],
        *[F.col("attrs")[i]["value"].alias(f"{i}:Value") for i in attribute_ids],
        *[F.col("attrs")[i]["formatted"].alias(f"{i}:FormattedValue") for i in attribute_ids],
    )


def columns_of(df: DataFrame) -> dict[str, str]:
    """Column names and types of a store."""
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}
