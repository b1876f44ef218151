"""From change-log messages to stores: items, references, nested rows, attributes and class mapping in one pass.

A batch of the log is judged for freshness, and the messages that count are opened once: payload decoded, envelope read,
language-independent rows laid over the message's language rows, standard fields typed by the header. What an item holds
in a language is what the last message that brings this language says, so languages a message leaves out stay; what hangs
below an item is what its last message says, language 0 copied to every language of that message. Then every store takes
its part.

Control messages act in log order: deleted workflows, states, languages and attributes, and removed item types, change what
was written before them and nothing written after. As a message replaces its whole row, that needs no barrier: every row
knows when it was written last, and a control message hits it if it came later.

Applying a log in any number of batches gives the stores that applying it at once does, because the freshness state is one
of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators.apply import apply_configuration, apply_mapping, replace_children, typed_columns
from tidemark.operators.cascade import FIELDS
from tidemark.operators.freshness import ARRIVAL, ITEM_KEY, fold_state, forget_types, judge, of_items
from tidemark.operators.language import INDEPENDENT
from tidemark.operators.sizes import measured
from tidemark.session import cut_lineage
from tidemark.sources.changes import decode_payload, read_delete, read_envelope, read_operation

# What a reference or nested row belongs to.
OWNER_KEY = ("SourceType", "type", "ItemID")
ROW_KEY = (*ITEM_KEY, "LanguageID")
# When a row was written, within a batch; null is before it.
AT = "__at"
CREATED_AT = "__created_at"


@dataclass(frozen=True)
class Stores:
    """All a feed keeps. Item stores are None before the first batch; attributes and mapping start from given tables."""

    attributes: DataFrame
    class_attributes: DataFrame
    freshness: DataFrame | None = None
    items: DataFrame | None = None
    references: DataFrame | None = None
    subtables: DataFrame | None = None

    def written(self) -> Stores:
        """The same stores, each written out."""
        return Stores(**{f.name: cut_lineage(getattr(self, f.name)) for f in fields(self)})


def _language(row: Column) -> Column:
    """Language of a message row; without one a row is language 1's."""
    return F.coalesce(row["LanguageID"].try_cast("bigint"), F.lit(1).cast("bigint"))


def _last(rows: Column) -> Column:
    return F.get(rows, F.size(rows) - 1)


def overlaid(rows: Column) -> Column:
    """Language rows of one message, with its language-independent row laid over each."""
    shared = _last(F.filter(rows, lambda r: _language(r) == INDEPENDENT))
    shared = F.map_filter(shared, lambda k, _: ~k.isin("LanguageID", "LanguageShortName"))
    own = F.filter(rows, lambda r: _language(r) != INDEPENDENT)
    over = F.transform(own, lambda r: F.map_concat(F.map_filter(r, lambda k, _: ~F.map_contains_key(shared, k)), shared))
    return F.when(shared.isNull(), own).otherwise(over)


def _languages(rows: Column) -> Column:
    """The languages of ``overlaid`` rows, in their order."""
    return F.transform(F.filter(rows, lambda r: _language(r) != INDEPENDENT), _language)


def _latest(rows: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The last row of each key. Unlike a maximum of the whole row it copies nothing for those that don't count."""
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("__place", F.row_number().over(newest)).where("__place = 1").drop("__place")


def open_messages(valid: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """Messages of items that were not deleted after them, with their envelope ``m``, decoded once and written."""
    at = F.struct(*arrival)
    deleted = valid.where(F.col("Action") == fixed.ACTION_DELETE).groupBy(*ITEM_KEY).agg(F.max(at).alias("__deleted"))
    living = valid.where(F.col("Action") != fixed.ACTION_DELETE).join(deleted, list(ITEM_KEY), "left")
    living = living.where(F.col("__deleted").isNull() | (at > F.col("__deleted")))
    envelope = read_envelope(decode_payload("Message"))
    return cut_lineage(living.select(*ITEM_KEY, "Action", "InsertTime", at.alias(AT), envelope.alias("m")))


def language_rows(opened: DataFrame) -> DataFrame:
    """One row per item and language: ``fields`` of the last message that brings the language, when it was written and
    whether by a create, and the time of the last create that brought it.

    Each task passes on one row for each key at most, so any number of messages of one item may come together. Rows are
    overlaid once it is known which count.
    """
    told = opened.select(
        *ITEM_KEY, "Action", "InsertTime", AT, F.col("m.Item").alias("__rows"),
        F.posexplode(_languages(F.col("m.Item"))).alias("__n", "LanguageID"),
    )
    last = _latest(told, ROW_KEY, AT, "__n").withColumn("fields", F.get(overlaid(F.col("__rows")), F.col("__n")))
    is_create = F.col("Action") == fixed.ACTION_CREATE
    created = told.where(is_create).groupBy(*[F.col(k).alias(f"__k_{k}") for k in ROW_KEY]).agg(
        F.max(F.struct(AT, "InsertTime")).alias("c")
    )
    joined = last.join(created, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in ROW_KEY], "left")
    return joined.select(
        *ROW_KEY, "fields", F.col("InsertTime").alias("_LastWritten"), F.col("c.InsertTime").alias("_InsertTime"),
        F.when(is_create, 1).otherwise(0).alias("_IsCreated"), AT, F.col(f"c.{AT}").alias(CREATED_AT),
    )


def last_children(opened: DataFrame) -> DataFrame:
    """References and nested rows of each item's last message, and the languages that message brings."""
    last = _latest(opened, ITEM_KEY, AT)
    languages = F.array_distinct(_languages(F.col("m.Item")))
    held = F.struct(F.col("m.Reference").alias("Reference"), F.col("m.Subtable").alias("Subtable"), languages.alias("languages"))
    return last.select(*ITEM_KEY, held.alias("m"), AT)


def child_rows(last: DataFrame, name: str, ident: str, source: str) -> DataFrame:
    """Reference or nested rows of last messages, language 0 copied to all languages of their message."""
    field = F.col("fields")
    number = lambda key: field[key].try_cast("bigint")
    rows = last.select(*ITEM_KEY, AT, F.col("m.languages").alias("languages"), F.explode(F.col("m")[name]).alias("fields"))
    own = F.coalesce(number("LanguageID"), F.lit(INDEPENDENT).cast("bigint"))
    target = F.when(own == INDEPENDENT, F.col("languages")).otherwise(F.array(own))
    return rows.select(
        F.col("item_type").alias("SourceType"),
        "type",
        F.col("ID").alias("ItemID"),
        F.explode(target).alias("LanguageID"),
        number("AttributeID").alias("AttributeID"),
        number(source).alias(ident),
        F.coalesce(number("_SubitemID"), F.col("ID")).alias("_SubitemID"),
        F.coalesce(number("SortOrder"), F.lit(0).cast("bigint")).alias("SortOrder"),
        "fields",
        AT,
    )


def named_deletes(changes: DataFrame) -> DataFrame:
    """Deletes of items and attributes name their own id and, in their message, any others: one change for each."""
    plural = (F.col("Action") == fixed.ACTION_DELETE) & (of_items() | (F.col("type") == fixed.TYPE_CONFIGURATION))
    others = F.filter(read_delete("ID", "Message")["ids"], lambda i: i.isNotNull())
    ids = F.when(plural, F.array_union(F.array(F.col("ID")), others)).otherwise(F.array(F.col("ID")))
    return changes.withColumn("ID", F.explode(ids))


def configuration_rows(changes: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """Configuration messages as ``apply_configuration`` takes them: the envelope's key and its first row."""
    envelope = read_envelope(decode_payload("Message"))
    rows = changes.where(F.col("type") == fixed.TYPE_CONFIGURATION).select("ID", "Action", *arrival, envelope.alias("m"))
    key = F.when(F.size("m.Reference") > 0, "Reference").when(F.size("m.Subtable") > 0, "Subtable").otherwise("Item")

    def first(name: str) -> Column:
        return F.get(F.col("m")[name], F.lit(0))

    return rows.select(
        "ID", "Action", *arrival, key.alias("envelope_key"),
        F.coalesce(first("Reference"), first("Subtable"), first("Item"), F.create_map().cast("map<string,string>"))
        .alias("fields"),
    )


def is_control() -> Column:
    """Changes that act on what others wrote: deleted workflows and languages, deleted attributes, operations."""
    deleted = F.col("Action") == fixed.ACTION_DELETE
    of_record = F.col("item_type").isin(fixed.RECORD_TYPES) & (F.col("type") == fixed.TYPE_ITEM)
    return (deleted & (of_record | (F.col("type") == fixed.TYPE_CONFIGURATION))) | (F.col("type") == fixed.TYPE_OPERATION)


def controls(changes: DataFrame, configuration: DataFrame, attributes: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """What control messages do, and when last: kind (value, language, attribute, type), item_type, field, value, at.

    A deleted attribute takes its values along unless it is a class link, by the last that is known of it.
    """
    at = F.struct(*arrival)
    none = F.lit(None)
    records = changes.where(is_control() & F.col("item_type").isin(fixed.RECORD_TYPES) & (F.col("type") == fixed.TYPE_ITEM))
    said = records.select("item_type", read_delete("ID", "Message").alias("d"), at.alias("at")).where("d.field IS NOT NULL")
    of_values = said.where(F.col("item_type") == "Workflow").select(
        F.lit("value").alias("kind"), F.lower("d.item_type").alias("item_type"), F.col("d.field").alias("field"),
        F.col("d.value").alias("value"), "at",
    )
    of_languages = said.where(F.col("item_type") == "Language").select(
        F.lit("language").alias("kind"), none.cast("string").alias("item_type"), F.lit("LanguageID").alias("field"),
        F.col("d.value").alias("value"), "at",
    )
    operation = read_operation("Message", "Action")
    of_types = changes.where(F.col("type") == fixed.TYPE_OPERATION).select(operation.alias("o"), at.alias("at")).where(
        "o.operation = 'itemTypeRemoved'"
    ).select(
        F.lit("type").alias("kind"), F.explode(F.transform("o.item_types", F.lower)).alias("item_type"),
        none.cast("string").alias("field"), none.cast("bigint").alias("value"), "at",
    )
    gone = configuration.where(F.col("Action") == fixed.ACTION_DELETE).groupBy("ID").agg(F.max(at).alias("at"))
    told = configuration.where(F.col("Action") != fixed.ACTION_DELETE).select("ID", at.alias("__at"), "fields")
    linked = (
        gone.join(told, "ID", "left")
        .groupBy("ID", "at")
        .agg(F.max_by(F.col("fields")["IsLink"], F.when(F.col("__at") < F.col("at"), F.col("__at"))).alias("__told"))
        .join(attributes.select("ID", F.col("IsLink").cast("string").alias("__known")), "ID", "left")
        .where(F.coalesce("__told", "__known", F.lit("0")) != "1")
    )
    of_attributes = linked.select(
        F.lit("attribute").alias("kind"), none.cast("string").alias("item_type"), none.cast("string").alias("field"),
        F.col("ID").alias("value"), "at",
    )
    every = of_values.unionByName(of_languages).unionByName(of_types).unionByName(of_attributes)
    return cut_lineage(every.groupBy("kind", "item_type", "field", "value").agg(F.max("at").alias("at")))


def _hits(control: Column) -> Column:
    """The control message is later than the row."""
    return control.isNotNull() & (F.col(AT).isNull() | (control > F.col(AT)))


def without_types(rows: DataFrame, done: DataFrame, column: str = "item_type") -> DataFrame:
    """Rows of removed types go, unless written later."""
    gone = done.where("kind = 'type'").select(F.col("item_type").alias("__type"), F.col("at").alias("__c"))
    joined = rows.join(measured(gone), F.lower(column) == F.col("__type"), "left")
    return joined.where(~_hits(F.col("__c"))).select(*rows.columns)


def without_attributes(rows: DataFrame, done: DataFrame, column: str, held: Sequence[DataFrame] = ()) -> DataFrame:
    """Values of deleted attributes go from a map of fields (``<id>:Value`` and so on).

    Deletions are looked up once for each set of attributes that rows have values of, by a join, so a row meets the deletions
    of its own attributes only, however many there are. ``held``: tables that have all the ``rows``, where reading these
    costs less.
    """
    gone = done.where("kind = 'attribute'").select(F.col("value").cast("string").alias("__id"), F.col("at").alias("__c"))
    if gone.isEmpty():
        return rows
    named = F.array_sort(F.array_distinct(F.transform(F.map_keys(column), lambda k: F.substring_index(k, ":", 1))))
    sets = reduce(DataFrame.unionByName, [df.select(named.alias("__ids")) for df in held or (rows,)]).distinct()
    found = sets.select("__ids", F.explode("__ids").alias("__id")).join(measured(gone), "__id")
    hit = cut_lineage(found.groupBy("__ids").agg(F.map_from_entries(F.collect_list(F.struct("__id", "__c"))).alias("__gone")))
    if hit.isEmpty():
        return rows
    control = lambda k: F.col("__gone")[F.substring_index(k, ":", 1)]
    kept = F.map_filter(column, lambda k, _: ~_hits(control(k)))
    return rows.withColumn("__ids", named).join(measured(hit), "__ids", "left").withColumn(column, kept).select(*rows.columns)


def without_languages(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of deleted languages go, unless written later; those forget a create that came before the deletion."""
    gone = done.where("kind = 'language'").select(F.col("value").alias("__language"), F.col("at").alias("__c"))
    joined = rows.join(measured(gone), F.col("LanguageID") == F.col("__language"), "left").where(~_hits(F.col("__c")))
    created = F.when(~F.coalesce(F.col("__c") > F.col(CREATED_AT), F.lit(False)), F.col("_InsertTime"))
    return joined.select(*[created.alias(c) if c == "_InsertTime" else c for c in rows.columns])


def controlled_items(items: DataFrame, done: DataFrame, held: Sequence[DataFrame] = ()) -> DataFrame:
    """Item rows after control messages: rows of removed types and deleted languages go, deleted workflows and states are
    cleared, values of deleted attributes go."""
    rows = without_languages(without_attributes(without_types(items, done), done, "attrs", held), done)
    values = done.where("kind = 'value'")
    hit = F.lit(False)
    for field in FIELDS:
        held = F.col(field).cast("bigint") if field in rows.columns else F.col("attrs")[field].try_cast("bigint")
        own = values.where(F.col("field") == field).select(
            F.col("item_type").alias(f"__t_{field}"), F.col("value").alias(f"__v_{field}"), F.col("at").alias(f"__c_{field}")
        )
        rows = rows.join(measured(own), (F.lower("item_type") == F.col(f"__t_{field}")) & (held == F.col(f"__v_{field}")), "left")
        hit = hit | _hits(F.col(f"__c_{field}"))
    cleared = F.transform_values("attrs", lambda k, v: F.when(k.isin(*FIELDS), F.lit("0")).otherwise(v))
    new = {f: F.when(hit, F.lit(0)).otherwise(F.col(f)).cast(items.schema[f].dataType) for f in FIELDS if f in items.columns}
    new["attrs"] = F.when(hit, cleared).otherwise(F.col("attrs"))
    return rows.select(*[new[c].alias(c) if c in new else c for c in items.columns])


def apply_feed(stores: Stores, changes: DataFrame, types: dict[str, str], arrival: Sequence[str] = ARRIVAL) -> Stores:
    """The stores after a batch of the log, written out.

    ``changes``: item_type, type, ID, Action, InsertTime, Message and the arrival columns; ``types`` gives the header
    types of the item columns, other fields stay in ``attrs``.
    """
    return merged(stores, cut_lineage(batch_rows(changes, arrival)), types, arrival).written()


def batch_rows(changes: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """What a batch of the log says, deletes of several ids as one change each."""
    return named_deletes(changes.select(*ITEM_KEY, "Action", "InsertTime", "Message", *arrival))


def merged(stores: Stores, changes: DataFrame, types: dict[str, str], arrival: Sequence[str] = ARRIVAL) -> Stores:
    """The stores after ``changes`` (written ``batch_rows``). Stores may be whole, or the parts that hold the batch's keys:
    every row that is given comes out as it stands after the batch. Control messages need whole stores."""
    configuration, mapping = configuration_rows(changes, arrival), changes.where(F.col("type") == fixed.TYPE_MAPPING)
    done = None
    if not changes.where(is_control()).isEmpty():
        done = controls(changes, configuration, stores.attributes, arrival)
        # What a removed type said before is forgotten, and so is what is known of its freshness.
        changes = cut_lineage(without_types(changes.withColumn(AT, F.struct(*arrival)), done).drop(AT))
    known = stores.freshness
    if known is not None and done is not None:
        removed = done.where("kind = 'type'").select(F.col("item_type").alias("__type"))
        known = forget_types(known.withColumn("__type", F.lower("item_type")), removed, "__type").drop("__type")
    judged = judge(changes, state=known, arrival=arrival)
    valid = cut_lineage(judged.where("verdict = 'valid'").drop("verdict").where(of_items()))
    opened = open_messages(valid, arrival)

    column_names = ["LanguageID", *types]
    attrs = F.map_filter("fields", lambda k, _: ~k.isin(column_names))
    rows = cut_lineage(language_rows(opened)).withColumn("attrs", attrs)
    new = typed_columns(rows, "fields", types)
    last = cut_lineage(last_children(opened))
    references = child_rows(last, "Reference", "ReferenceID", "CSReferenceID")
    subtables = child_rows(last, "Subtable", "ItemTableID", "ItemTableID")
    items = new
    held = {name: [df for df in (getattr(stores, name), own) if df is not None]
            for name, own in (("items", new), ("references", references), ("subtables", subtables))}
    if stores.items is not None:
        gone = valid.where(F.col("Action") == fixed.ACTION_DELETE).select(*ITEM_KEY).distinct()
        nothing = F.lit(None).cast(new.schema[AT].dataType)
        old = stores.items.join(gone, list(ITEM_KEY), "left_anti").withColumns({AT: nothing, CREATED_AT: nothing})
        if done is not None:
            old = without_languages(without_types(old, done), done)
        # An update keeps the time its row was created.
        before = old.select(*ROW_KEY, F.col("_InsertTime").alias("__created"))
        dated = new.join(before, list(ROW_KEY), "left").withColumn("_InsertTime", F.coalesce("_InsertTime", "__created"))
        kept = old.join(new.select(*ROW_KEY), list(ROW_KEY), "left_anti")
        items = kept.select(*new.columns).unionByName(dated.select(*new.columns))
        owners = valid.select(F.col("item_type").alias("SourceType"), "type", F.col("ID").alias("ItemID")).distinct()
        references = replace_children(stores.references.withColumn(AT, nothing), owners, references, OWNER_KEY)
        subtables = replace_children(stores.subtables.withColumn(AT, nothing), owners, subtables, OWNER_KEY)
    if done is not None:
        items = controlled_items(items, done, held["items"])
        references, subtables = (
            without_attributes(without_types(rows, done, "SourceType"), done, "fields", held[name])
            for name, rows in (("references", references), ("subtables", subtables))
        )
    return Stores(
        apply_configuration(stores.attributes, configuration, arrival),
        apply_mapping(stores.class_attributes, mapping, arrival),
        fold_state(changes, known),
        items.drop(AT, CREATED_AT),
        references.drop(AT),
        subtables.drop(AT),
    )
