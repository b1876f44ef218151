"""The change log as a batch table or a stream, and reading what its messages say."""

from __future__ import annotations

import base64
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark import fixed
from tidemark.functions.text import _col, comma_list

# Columns of the log, plus the two the log keeps in its table name.
CHANGE_SCHEMA = (
    "ID bigint, Message string, Action int, InsertTime bigint, JMSPriority int, JobID bigint, VersionNr int, "
    "ProducerStatus int, item_type string, type string"
)
ENVELOPE_SCHEMA = (
    "Item array<map<string,string>>, Record array<map<string,string>>, Reference array<map<string,string>>, "
    "Subtable array<map<string,string>>"
)
OPERATION_SCHEMA = (
    "Item string, DebugMode string, MVFields map<string,array<string>>, "
    "Reindex struct<ItemType:string,AffectedItemIDs:array<string>,SearchableFields:array<string>>"
)


def read_changes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The log as files."""
    return spark.read.format(fmt).schema(CHANGE_SCHEMA).load(path)


def read_changes_jdbc(
    spark: SparkSession, url: str, table: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """The log straight from its database, read in parallel ranges of InsertTime (needs the JDBC driver jar)."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn="InsertTime", **options)
        .options(lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions))
        .load()
    )


def stream_changes(spark: SparkSession, path: str, files_per_trigger: int = 100, fmt: str = "parquet",
                   schema: str = CHANGE_SCHEMA) -> DataFrame:
    """The log as a stream; the trigger size bounds a micro-batch, the checkpoint replaces acknowledgements."""
    return (
        spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)
    )


def message_kind(message: Column | str) -> Column:
    """Item, unless the envelope holds Record, DebugMode or Reindex (in this order); anything unreadable is Item."""
    envelope = F.try_parse_json(_col(message))

    def holds(key: str) -> Column:
        # is_variant_null separates a key holding null from a key that is absent.
        return F.try_variant_get(envelope, f"$.{key}", "variant").isNotNull()

    return (
        F.when(holds(fixed.KEY_RECORD), fixed.KEY_RECORD)
        .when(holds(fixed.KEY_DEBUG_MODE), fixed.KEY_DEBUG_MODE)
        .when(holds(fixed.KEY_REINDEX), fixed.KEY_REINDEX)
        .otherwise(fixed.TYPE_ITEM)
    )


def change_kind(message: Column | str, kind: Column | str, action: Column | str) -> Column:
    """Only Item changes that are no deletes are looked into."""
    inspected = (_col(kind) == fixed.TYPE_ITEM) & (_col(action) != fixed.ACTION_DELETE)
    return F.when(inspected, message_kind(message)).otherwise(fixed.TYPE_ITEM)


# Spark has no zlib expression, so these two run in Python, one Arrow batch at a time. They are made inside functions
# to travel with the plan instead of being imported by the workers.
def _inflate(packed: Column) -> Column:
    def one(data):
        try:
            return None if data is None else zlib.decompress(data).decode("utf-8")
        except (zlib.error, UnicodeDecodeError):
            return None

    @F.pandas_udf(StringType())
    def inflate(values: pd.Series) -> pd.Series:
        return values.map(one)

    return inflate(packed)


def _deflate(text: Column) -> Column:
    def one(value):
        return None if value is None else base64.b64encode(zlib.compress(value.encode("utf-8"))).decode("ascii")

    @F.pandas_udf(StringType())
    def deflate(values: pd.Series) -> pd.Series:
        return values.map(one)

    return deflate(text)


def decode_payload(message: Column | str) -> Column:
    """Base64 + zlib payload as text; a message that is neither stays as it is."""
    message = _col(message)
    return F.coalesce(_inflate(F.try_to_binary(message, F.lit("base64"))), message)


def encode_payload(text: Column | str) -> Column:
    """The packed form of a message."""
    return _deflate(_col(text))


def read_envelope(message: Column | str) -> Column:
    """Item, record, reference and nested rows of a message."""
    return F.from_json(_col(message), ENVELOPE_SCHEMA)


def big_attributes(message: Column | str) -> Column:
    """language → long attributes. In the array form the language is the position and position 0 joins every other."""
    message = _col(message)
    raw = F.get_json_object(message, "$._BigDataAttributes")
    listed = F.from_json(raw, "array<array<string>>")
    first = F.get(listed, F.lit(0))
    by_position = F.map_from_entries(
        F.filter(
            F.transform(
                listed,
                lambda names, i: F.struct(
                    i.cast("string").alias("key"),
                    F.when(first.isNull() | (i == 0), names)
                    .when(names.isNull(), first)
                    .otherwise(F.array_union(first, names))
                    .alias("value"),
                ),
            ),
            lambda e: e["value"].isNotNull(),
        )
    )
    return F.when(raw.startswith("["), by_position).otherwise(
        F.coalesce(F.from_json(raw, "map<string,array<string>>"), F.create_map().cast("map<string,array<string>>"))
    )


def read_operation(message: Column | str, action: Column | str) -> Column:
    """Operation message: kind, item types, affected ids, searchable fields and lookup fields per type."""
    parsed = F.from_json(_col(message), OPERATION_SCHEMA)
    action = _col(action)
    kind = (
        F.when(parsed["DebugMode"].isNotNull(), fixed.KEY_DEBUG_MODE)
        .when(parsed["Reindex"].isNotNull(), fixed.KEY_REINDEX)
        .when(action == fixed.ACTION_INITIAL, "initialize")
        .when(action == fixed.ACTION_UPDATE, "itemTypeAdded")
        .when(action == fixed.ACTION_DELETE, "itemTypeRemoved")
    )
    types = F.coalesce(parsed["Item"], parsed["DebugMode"], parsed["Reindex"]["ItemType"])
    return F.struct(
        kind.alias("operation"),
        comma_list(F.replace(types, F.lit(" "), F.lit(""))).alias("item_types"),
        parsed["Reindex"]["AffectedItemIDs"].alias("affected_ids"),
        parsed["Reindex"]["SearchableFields"].alias("searchable_fields"),
        parsed["MVFields"].alias("lookup_fields"),
    )


def read_delete(change_id: Column | str, message: Column | str) -> Column:
    """Delete message: plain ids, or (id, item type, field, field value) for a deleted workflow, state or language."""
    parts = comma_list(F.replace(_col(message), F.lit(" "), F.lit("")))
    cascade = (F.size(parts) >= 4) & parts[1].try_cast("bigint").isNull()
    own = F.array(_col(change_id).cast("bigint"))
    return F.struct(
        F.when(cascade, F.array(F.get(parts, F.lit(0)).try_cast("bigint")))
        .when(F.size(parts) > 0, F.transform(parts, lambda p: p.try_cast("bigint")))
        .otherwise(own)
        .alias("ids"),
        F.when(cascade, F.get(parts, F.lit(1))).alias("item_type"),
        F.when(cascade, F.get(parts, F.lit(2))).alias("field"),
        F.when(cascade, F.get(parts, F.lit(3)).try_cast("bigint")).alias("value"),
    )
