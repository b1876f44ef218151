"""Map and JSON expressions over attribute maps and message fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.text import _col

# --- fixed values: patterns of attribute field names ----------------------------------------------------
VALUE_FIELD = r"^-?[0-9]+:Value$"
FORMATTED_FIELD = r"^-?[0-9]+:FormattedValue$"
NOTICE_FIELD = r"^-?[0-9]+:(Formatted)?Value$"


def values(attrs: Column | str) -> Column:
    """attribute id → value of an attribute map."""
    return F.transform_values(_col(attrs), lambda _, v: v["value"])


def formatted_values(attrs: Column | str) -> Column:
    """attribute id → formatted value of an attribute map."""
    return F.transform_values(_col(attrs), lambda _, v: v["formatted"])


def attributes_of(fields: Column | str) -> Column:
    """``<id>:Value`` / ``<id>:FormattedValue`` fields as id → (value, formatted)."""
    fields = _col(fields)
    ids = F.transform(
        F.filter(F.map_keys(fields), lambda k: k.rlike(VALUE_FIELD)), lambda k: F.split_part(k, F.lit(":"), F.lit(1))
    )
    return F.map_from_entries(
        F.transform(
            ids,
            lambda i: F.struct(
                i.cast("bigint").alias("key"),
                F.struct(
                    F.element_at(fields, F.concat(i, F.lit(":Value"))).alias("value"),
                    F.element_at(fields, F.concat(i, F.lit(":FormattedValue"))).alias("formatted"),
                ).alias("value"),
            ),
        )
    )


def standard_map(columns: list[str]) -> Column:
    """Typed columns rendered as text, by name."""
    entries: list[Column] = []
    for name in columns:
        entries += [F.lit(name), F.col(name).cast("string")]
    return F.create_map(*entries)


def keep_keys(m: Column | str, names: Column) -> Column:
    """Entries whose key is in the array."""
    return F.map_filter(_col(m), lambda k, _: F.array_contains(names, k))


def keep_paths(m: Column | str, paths: Sequence[str], below: str = "") -> Column:
    """Source filtering: a plain path keeps one key, ``prefix.*`` every key below the prefix. ``below`` is the path of the
    map itself: its keys stand for all that they hold."""
    def wanted(key: Column) -> Column:
        path = F.concat(F.lit(f"{below}."), key, F.lit(".")) if below else key
        hit = path.isin([p for p in paths if not p.endswith(".*")])
        for prefix in (p[:-1] for p in paths if p.endswith(".*")):
            hit = hit | path.startswith(prefix)
        return hit

    return F.map_filter(_col(m), lambda k, _: wanted(k))


def without_attributes(m: Column | str, ids: list[int]) -> Column:
    """Drop both value fields of the configured dynamic attributes."""
    names = [f"{i}:{suffix}" for i in ids for suffix in ("Value", "FormattedValue")]
    return F.map_filter(_col(m), lambda k, _: ~k.isin(names)) if names else _col(m)


def without_nulls(m: Column | str) -> Column:
    """Drop entries without a value."""
    return F.map_filter(_col(m), lambda _, v: v.isNotNull())


def inverted(m: Column | str) -> Column:
    """Values become keys."""
    return F.map_from_arrays(F.map_values(_col(m)), F.map_keys(_col(m)))


def json_map(c: Column | str) -> Column:
    """JSON object text as a map of text; text that is no object gives an empty map."""
    return F.coalesce(F.from_json(_col(c), "map<string,string>"), F.create_map().cast("map<string,string>"))


def notice_language_part(fields: Column | str) -> Column:
    """Fields of a change notice that belong to one language."""
    return F.map_filter(
        _col(fields), lambda k, _: k.rlike(NOTICE_FIELD) | k.isin(fixed.NOTICE_LANGUAGE_FIELDS)
    )


def notice_root_part(fields: Column | str) -> Column:
    """Fields of a change notice that belong to the item; names starting with an underscore stay private."""
    return F.map_filter(
        _col(fields),
        lambda k, _: ~(k.rlike(NOTICE_FIELD) | k.isin(fixed.NOTICE_LANGUAGE_FIELDS) | k.startswith("_")),
    )


def field_value(field: Column, attrs: Column, standard: Column, part: str = "value") -> Column:
    """Value of a field by name: digits or a minus sign mean an attribute id, anything else a standard field."""
    return F.when(field.rlike("^[0-9-]"), F.element_at(attrs, field.try_cast("bigint"))[part]).otherwise(
        F.element_at(standard, field)
    )
