"""Lookup tables: which items have a value in a field, as one narrow inverted table that changes with its items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators.freshness import ITEM_KEY

LOOKUP_ROW = (*ITEM_KEY, "LanguageID", "field", "value")


def default_fields(item_type: Column | str = "item_type") -> Column:
    """Fields every type is looked up by: views by what they extend as well, users neither by workflow nor by state."""
    kind = F.col(item_type) if isinstance(item_type, str) else item_type
    names = lambda fields: F.array(*[F.lit(f) for f in fields])
    plain = [f for f in fixed.LOOKUP_FIELDS if f != fixed.LOOKUP_OF_VIEWS]
    return (
        F.when(F.lower(kind).endswith(fixed.VIEW_SUFFIX), names(fixed.LOOKUP_FIELDS))
        .when(kind == "User", names([f for f in plain if f not in fixed.LOOKUP_SKIPPED_FOR_USER]))
        .otherwise(names(plain))
    )


def lookup_rows(items: DataFrame, fields: Sequence[str] = fixed.LOOKUP_FIELDS) -> DataFrame:
    """(item key, LanguageID, field, value) of every item row and each of its type's fields that has a value.

    A field is a column of the items or an entry of their ``attrs``; values are text.
    """
    wanted = default_fields()

    def value(name: str) -> Column:
        return F.col(name).cast("string") if name in items.columns else F.col("attrs")[name]

    held = [F.struct(F.lit(f).alias("field"), value(f).alias("value")) for f in fields]
    rows = items.select(*ITEM_KEY, "LanguageID", wanted.alias("__wanted"), F.inline(F.array(*held)))
    return rows.where(F.array_contains("__wanted", F.col("field")) & F.col("value").isNotNull()).drop("__wanted")


def lookup_changes(before: DataFrame | None, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lookup rows to retract and to add when items go from ``before`` to ``after``; what stays is in neither."""
    new = lookup_rows(after)
    if before is None:
        return new.limit(0), new
    old = lookup_rows(before)
    return old.join(new, list(LOOKUP_ROW), "left_anti"), new.join(old, list(LOOKUP_ROW), "left_anti")


def moved(lookups: DataFrame | None, retracted: DataFrame, added: DataFrame) -> DataFrame:
    """Lookups without what is retracted and with what is added."""
    kept = added.limit(0) if lookups is None else lookups.join(retracted, list(LOOKUP_ROW), "left_anti")
    return kept.select(*LOOKUP_ROW).unionByName(added.select(*LOOKUP_ROW))
