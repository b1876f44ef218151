"""Changes turned into item, record, reference, nested-table, configuration and mapping state.

Every merge is one join on the key: old rows that are not touched pass, touched ones are replaced, deleted ones go.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.coerce import coerce, default_of, split_ids
from tidemark.functions.text import comma_list
from tidemark.operators.freshness import ARRIVAL, ITEM_KEY


def latest(
    changes: DataFrame,
    keys: Sequence[str] = ITEM_KEY,
    arrival: Sequence[str] = ARRIVAL,
    payload: Sequence[str] = ("Message",),
) -> DataFrame:
    """The last change of every key, with the time of its last create (if no delete followed it).

    Aggregates combine on the map side, so a hot key reaches the shuffle as one row per task.
    """
    at = F.struct(*arrival)
    carried = ["Action", "InsertTime", *payload]
    created = F.max(F.when(F.col("Action") == fixed.ACTION_CREATE, F.struct(*arrival, "InsertTime")))
    deleted = F.max(F.when(F.col("Action") == fixed.ACTION_DELETE, at))
    merged = changes.groupBy(*keys).agg(
        F.max_by(F.struct(*carried), at).alias("last"), created.alias("created"), deleted.alias("deleted")
    )
    created_at = F.struct(*[F.col(f"created.{c}").alias(c) for c in arrival])
    alive = F.col("deleted").isNull() | (created_at > F.col("deleted"))
    return merged.select(
        *keys,
        *[F.col(f"last.{c}").alias(c) for c in carried],
        F.when(F.col("created").isNotNull() & alive, F.col("created.InsertTime")).alias("CreatedAt"),
    )


def upsert_items(
    store: DataFrame | None, changes: DataFrame, keys: Sequence[str] = ITEM_KEY, payload: Sequence[str] = ("Message",)
) -> DataFrame:
    """New item state: payload, ``_LastWritten``, ``_InsertTime`` (of the create) and ``_IsCreated``.

    ``changes`` is the output of ``latest``. An update keeps the stored ``_InsertTime``; a delete removes the key.
    """
    new = changes.select(
        *keys,
        "Action",
        *payload,
        F.col("InsertTime").alias("_LastWritten"),
        F.col("CreatedAt").alias("_InsertTime"),
        F.when(F.col("Action") == fixed.ACTION_CREATE, 1).otherwise(0).alias("_IsCreated"),
    )
    columns = [*keys, *payload, "_LastWritten", "_InsertTime", "_IsCreated"]
    alive = F.col("Action") != fixed.ACTION_DELETE
    if store is None:
        return new.where(alive).select(*columns)
    old = store.select(*[F.col(c).alias(f"__old_{c}") for c in columns])
    match = [F.col(k).eqNullSafe(F.col(f"__old_{k}")) for k in keys]
    touched = F.col("Action").isNotNull()

    def pick(c: str) -> Column:
        if c in keys:
            return F.coalesce(F.col(c), F.col(f"__old_{c}"))
        if c == "_InsertTime":
            return F.coalesce(F.col(c), F.col(f"__old_{c}"))
        return F.when(touched, F.col(c)).otherwise(F.col(f"__old_{c}"))

    return old.join(new, match, "full").where(~touched | alive).select(*[pick(c).alias(c) for c in columns])


def typed_columns(rows: DataFrame, fields: str, types: dict[str, str], now: Column | None = None) -> DataFrame:
    """Message fields under their header types; a field the message leaves out gets its type's default."""
    present = F.col(fields)
    return rows.select(
        *[c for c in rows.columns if c != fields],
        *[
            F.when(F.map_contains_key(present, F.lit(name)), coerce(present[name], kind, now))
            .otherwise(default_of(kind))
            .alias(name)
            for name, kind in types.items()
        ],
    )


def replace_children(
    children: DataFrame, changed_items: DataFrame, new_rows: DataFrame, key: Sequence[str] = ("SourceType", "ItemID")
) -> DataFrame:
    """Replace all rows of the changed items; an item without new rows loses its rows. ``key`` names the owner: its
    type (SourceType of references, ItemType of nested rows) and id."""
    owners = changed_items.select(*key).distinct()
    return children.join(owners, list(key), "left_anti").unionByName(new_rows.join(owners, list(key), "left_semi"))


def delete_items(
    items: DataFrame, references: DataFrame, subtables: DataFrame, deleted: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Remove items in all languages with their references and nested rows.

    ``deleted`` and ``items`` have item_type and ID; references name their owner's type SourceType, nested rows ItemType.
    """
    gone = deleted.select("item_type", "ID").distinct()

    def without(rows: DataFrame, kind: str, ident: str) -> DataFrame:
        owners = gone.select(F.col("item_type").alias(kind), F.col("ID").alias(ident))
        return rows.join(owners, [kind, ident], "left_anti").select(*rows.columns)

    return without(items, "item_type", "ID"), without(references, "SourceType", "ItemID"), without(subtables, "ItemType", "ItemID")


def replace_records(records: DataFrame, incoming: DataFrame, key: str = "ID") -> DataFrame:
    """Records are deleted by id and inserted again with all their columns; each of their states becomes a row of its
    own that carries the record's other columns along.

    ``incoming``: the records' columns and ``states``, an array of structs whose fields replace the columns of that name.
    """
    state = F.col("__state")
    element = incoming.schema["states"].dataType.elementType
    own = incoming.drop("states")
    states = incoming.withColumn("__state", F.explode("states")).select(
        *[state[c].alias(c) if c in element.fieldNames() else F.col(c) for c in own.columns]
    )
    kept = records.join(incoming.select(key).distinct(), key, "left_anti").select(*records.columns)
    return kept.unionByName(own.unionByName(states), allowMissingColumns=True)


def apply_configuration(attributes: DataFrame, changes: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """Attribute rows after configuration changes, in all their columns.

    ``changes``: ID, Action, envelope_key (Item, Reference, Subtable), fields, arrival. A message replaces the whole row:
    a column it leaves out gets its type's default. Untouched rows stay as they are. The kind follows the envelope:
    folder 0 or standard 1 for items, 2 for references, 3 for nested tables.
    """
    carried = F.struct("Action", "envelope_key", "fields")
    last = changes.groupBy("ID").agg(F.max_by(carried, F.struct(*arrival)).alias("last"))
    fields = F.col("last.fields")
    kind = (
        F.when(F.col("last.envelope_key") == "Reference", fixed.KIND_REFERENCE)
        .when(F.col("last.envelope_key") == "Subtable", fixed.KIND_SUBTABLE)
        .when(fields["IsFolder"] == "1", fixed.KIND_FOLDER)
        .otherwise(fixed.KIND_STANDARD)
    )

    def value(name: str) -> Column:
        if name == "_TypeID":
            return kind
        own = attributes.schema[name].dataType.simpleString()
        own = "text" if own == "string" else own
        return F.when(F.map_contains_key(fields, F.lit(name)), coerce(fields[name], own)).otherwise(default_of(own))

    columns = [c for c in attributes.columns if c != "ID"]
    new = last.select(
        F.col("ID").alias("__id"), F.col("last.Action").alias("__action"), *[value(c).alias(f"__new_{c}") for c in columns]
    )
    touched = F.col("__id").isNotNull()
    return (
        attributes.join(new, F.col("ID") == F.col("__id"), "full")
        .where(~touched | (F.col("__action") != fixed.ACTION_DELETE))
        .select(
            *[
                F.coalesce("__id", "ID").alias("ID")
                if c == "ID"
                else F.when(touched, F.col(f"__new_{c}")).otherwise(F.col(c)).cast(attributes.schema[c].dataType).alias(c)
                for c in attributes.columns
            ]
        )
    )


def registered_columns(changes: DataFrame) -> DataFrame:
    """(store, AttributeID) pairs configuration changes open: own id of a standard attribute in the item table,
    the listed sub-attributes of references and nested tables in theirs."""
    fields = F.col("fields")
    standard = changes.where((F.col("envelope_key") == "Item") & (F.coalesce(fields["IsFolder"], F.lit("0")) != "1"))
    nested = changes.where(F.col("envelope_key").isin("Reference", "Subtable")).select(
        F.lower("envelope_key").alias("store"), F.explode(comma_list(fields["_SubAttributes"])).alias("AttributeID")
    )
    return (
        standard.select(F.lit("item").alias("store"), F.col("ID").alias("AttributeID"))
        .unionByName(nested.select("store", F.col("AttributeID").cast("bigint").alias("AttributeID")))
        .distinct()
    )


def apply_mapping(
    class_attributes: DataFrame, changes: DataFrame, arrival: Sequence[str] = ARRIVAL
) -> DataFrame:
    """Class mapping after mapping changes (ID = class, Message = attribute ids): pairs are added, never removed,
    and class -1 empties the table, so only pairs after the last -1 remain."""
    at = F.struct(*arrival)
    cut = changes.where(F.col("ID") == -1).agg(F.max(at).alias("cut"))
    pairs = changes.where(F.col("ID") != -1).select(
        F.col("ID").alias("ClassID"), F.explode(split_ids("Message")).alias("AttributeID"), at.alias("at")
    )
    # The cut is one row; as a scalar it needs no join.
    last_cut = cut.select("cut").scalar()
    kept = class_attributes.where(last_cut.isNull()).select("ClassID", "AttributeID")
    added = pairs.where(last_cut.isNull() | (F.col("at") > last_cut)).select("ClassID", "AttributeID")
    return kept.unionByName(added).distinct()
