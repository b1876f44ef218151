"""What else changes when a workflow, a state, a language or an item type goes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizes import is_small, measured
from tidemark.session import cut_lineage


FIELDS = ("WorkflowID", "StateID")


def flag_deleted(items: DataFrame, deleted: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Items with a flag ``deleted_<field>`` for each field: whether the item carries a deleted value of it.

    ``deleted``: field, value, and item_type where the items have one; a deletion concerns items of its type only. It is a
    small table: written once, counted, and joined in one pass over the items.
    """
    typed = ["item_type"] if "item_type" in items.columns and "item_type" in deleted.columns else []
    gone = cut_lineage(deleted.select(*typed, "field", "value").distinct())
    small, rows = is_small(gone), items
    for field in fields:
        values = gone.where(F.col("field") == field).select(
            *[F.col(t).alias(f"__d_{t}") for t in typed], F.col("value").alias("__value"), F.lit(True).alias("__hit")
        )
        match = [rows[field] == F.col("__value"), *[rows[t] == F.col(f"__d_{t}") for t in typed]]
        joined = rows.join(F.broadcast(values) if small else values, match, "left")
        rows = joined.select(*rows.columns, F.coalesce("__hit", F.lit(False)).alias(f"deleted_{field}"))
    return rows


def affected_items(items: DataFrame, deleted: DataFrame, field: str) -> DataFrame:
    """Items carrying a deleted value of ``field``."""
    return flag_deleted(items, deleted, (field,)).where(F.col(f"deleted_{field}")).select(*items.columns)


def clear_workflows(items: DataFrame, deleted: DataFrame, keep_flags: bool = False) -> DataFrame:
    """Items in a deleted workflow or state lose both: WorkflowID = 0 and StateID = 0."""
    flagged = flag_deleted(items, deleted)
    flags = [F.col(f"deleted_{f}") for f in FIELDS]
    hit = flags[0] | flags[1]
    return flagged.select(
        *[F.when(hit, F.lit(0)).otherwise(F.col(c)).alias(c) if c in FIELDS else F.col(c) for c in items.columns],
        *flags * keep_flags,
    )


def clear_document_workflows(docs: DataFrame, deleted: DataFrame) -> DataFrame:
    """Documents whose ``fields`` carry a deleted workflow or state lose both there, as their items do."""
    named = docs.withColumns({f: F.col("fields")[f].try_cast("bigint") for f in FIELDS})
    flagged = flag_deleted(named, deleted)
    hit = F.col("deleted_WorkflowID") | F.col("deleted_StateID")
    cleared = F.transform_values("fields", lambda k, v: F.when(k.isin(*FIELDS), F.lit("0")).otherwise(v))
    return flagged.withColumn("fields", F.when(hit, cleared).otherwise(F.col("fields"))).select(*docs.columns)


def drop_languages(items: DataFrame, deleted: DataFrame) -> DataFrame:
    """All rows of a deleted language go. ``deleted``: LanguageID."""
    return items.join(measured(deleted.select("LanguageID").distinct()), "LanguageID", "left_anti").select(*items.columns)


def change_types(rows: DataFrame, added: DataFrame, removed: DataFrame, column: str = "item_type") -> DataFrame:
    """Rows after an item-type operation: those of removed types go, those of added types come."""
    gone = measured(removed.select(column).distinct())
    return rows.unionByName(added).join(gone, column, "left_anti").select(*rows.columns)


def drop_attributes(items: DataFrame, attributes: DataFrame, deleted: DataFrame) -> DataFrame:
    """Attribute values go with their attribute; a deleted class link takes none. ``deleted``: ID.

    The deleted ids are one metadata array, applied inside the row.
    """
    gone = (
        attributes.join(deleted.select("ID").distinct(), "ID", "left_semi")
        .where(F.col("IsLink") == 0)
        .agg(F.collect_set("ID").alias("ids"))
        .scalar()
    )
    kept = F.map_filter("attrs", lambda k, _: ~F.array_contains(F.col("__gone"), k))
    return items.withColumn("__gone", gone).withColumn("attrs", kept).drop("__gone")
