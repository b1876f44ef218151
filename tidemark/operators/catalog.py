"""Attributes, classes and languages of the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.maps import json_map
from tidemark.functions.text import id_list
from tidemark.operators.gather import gather
from tidemark.operators.sizes import measured
from tidemark.session import cut_lineage

SPECIAL_KINDS = [fixed.KIND_FOLDER, fixed.KIND_REFERENCE, fixed.KIND_SUBTABLE]
# --- fixed values: numbered parameters of an attribute --------------------------------------------------
PARAMETERS = ["ParamA", "ParamB", "ParamC", "ParamD", "ParamE", "ParamF", "ParamG", "ParamH", "ParamI", "ParamJ"]


def attributes_of_kind(attributes: DataFrame, kind: int) -> DataFrame:
    """Attributes of one kind: folder, standard, reference or nested table."""
    return attributes.where(F.col("_TypeID") == kind)


def attribute_objects(attributes: DataFrame) -> DataFrame:
    """Attribute rows as objects: the plain fields, numbered parameters as a map, properties out of their JSON."""
    present = [p for p in PARAMETERS if p in attributes.columns]
    pairs = [x for p in present for x in (F.lit(p), F.col(p))]
    params = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    plain = [c for c in attributes.columns if c not in (*PARAMETERS, "PropertyValues")]
    properties = json_map("PropertyValues") if "PropertyValues" in attributes.columns else json_map(F.lit(None))
    return attributes.select(*plain, params.alias("params"), properties.alias("properties"))


def attributes_by_class(class_attributes: DataFrame, class_id: int) -> DataFrame:
    """Attribute ids of a class."""
    return class_attributes.where(F.col("ClassID") == class_id).select("AttributeID").distinct()


def ids_by_external_key(attributes: DataFrame) -> DataFrame:
    """External key → attribute id; the last one wins when a key repeats, keys without text are left out."""
    return (
        attributes.where(F.coalesce(F.col("ExternalKey"), F.lit("")) != "")
        .groupBy("ExternalKey")
        .agg(F.max("ID").alias("AttributeID"))
    )


def children(attributes: DataFrame) -> DataFrame:
    """Sorted child ids per parent, links excluded, in parts of bounded size."""
    return gather(
        attributes.where(F.col("IsLink") == 0).select("ParentID", "ID"), ["ParentID"], F.col("ID"), ["ID"], "children"
    )


def class_lists_to_attributes(
    class_lists: DataFrame, class_attributes: DataFrame, column: str = "ClassMapping"
) -> DataFrame:
    """(class list, AttributeID) of every distinct class list; an empty list takes the attributes of class 0.

    Items share few class lists, so the join runs once per list instead of once per item.
    """
    distinct = class_lists.select(column).distinct()
    ids = id_list(column)
    classes = F.when(F.size(ids) == 0, F.array(F.lit(0).cast("bigint"))).otherwise(F.array_distinct(ids))
    return (
        distinct.select(column, F.explode(classes).alias("ClassID"))
        .join(measured(class_attributes.select("ClassID", "AttributeID").distinct()), "ClassID")
        .select(column, "AttributeID")
        .distinct()
    )


def effective_attributes(
    items: DataFrame,
    class_attributes: DataFrame,
    attributes: DataFrame | None = None,
    plugin_ids: list[int] | None = None,
    columns: tuple[str, ...] = ("ClassMapping",),
    keep_special: bool = False,
) -> DataFrame:
    """Per distinct class list of the items: sorted array ``attribute_ids``.

    Several ``columns`` are united (a view item adds the classes of its base item); plugin attributes belong to
    every item; folders, references and nested tables are left out unless ``keep_special``.
    """
    lists = items.select(*columns).distinct()
    assigned = None
    for i, column in enumerate(columns):
        found = class_lists_to_attributes(lists if i == 0 else lists.where(F.size(id_list(column)) > 0),
                                          class_attributes, column)
        if len(columns) > 1:
            found = found.withColumnRenamed(column, "__list")
            found = lists.join(found, F.col(column).eqNullSafe(F.col("__list"))).select(*columns, "AttributeID")
        assigned = found if assigned is None else assigned.union(found)
    if plugin_ids:
        plugins = lists.select(
            *columns, F.explode(F.array(*[F.lit(i).cast("bigint") for i in plugin_ids])).alias("AttributeID")
        )
        assigned = assigned.union(plugins)
    if attributes is not None and not keep_special:
        special = attributes.where(F.col("_TypeID").isin(SPECIAL_KINDS)).select(F.col("ID").alias("AttributeID"))
        assigned = assigned.join(special, "AttributeID", "left_anti")
    return assigned.groupBy(*columns).agg(F.sort_array(F.collect_set("AttributeID")).alias("attribute_ids"))


def with_effective_attributes(
    items: DataFrame, effective: DataFrame, columns: str | tuple[str, ...] = ("ClassMapping",)
) -> DataFrame:
    """Items with ``attribute_ids`` of their class lists. Lists are few: they are written once, then counted and joined."""
    columns = (columns,) if isinstance(columns, str) else columns
    lists = cut_lineage(effective.select(*[F.col(c).alias(f"__l_{c}") for c in columns], "attribute_ids"))
    same = [F.col(c).eqNullSafe(F.col(f"__l_{c}")) for c in columns]
    return items.join(measured(lists), same, "left").select(*items.columns, "attribute_ids")


def assigned_of_kind(
    items: DataFrame,
    class_attributes: DataFrame,
    attributes: DataFrame,
    kind: int,
    plugin_ids: list[int] | None = None,
    columns: tuple[str, ...] = ("ClassMapping",),
) -> DataFrame:
    """(``columns``, AttributeID): attributes of one kind that the class lists (and plugins) assign."""
    wanted = attributes_of_kind(attributes, kind).select(F.col("ID").alias("AttributeID"))
    lists = effective_attributes(items, class_attributes, None, plugin_ids, columns, keep_special=True)
    return lists.select(*columns, F.explode("attribute_ids").alias("AttributeID")).join(wanted, "AttributeID", "left_semi")


def assigned_by_class(class_attributes: DataFrame, attributes: DataFrame) -> DataFrame:
    """(ClassID, ``class_ids``): the plain attributes of each class, sorted; one row per class."""
    special = attributes.where(F.col("_TypeID").isin(SPECIAL_KINDS)).select(F.col("ID").alias("AttributeID"))
    plain = class_attributes.select("ClassID", "AttributeID").join(special, "AttributeID", "left_anti")
    return plain.groupBy("ClassID").agg(F.sort_array(F.collect_set("AttributeID")).alias("class_ids"))


def workflow_states(records: DataFrame) -> DataFrame:
    """Sorted states per workflow, without the workflow's own row (state 0), in parts of bounded size."""
    return gather(
        records.where(F.col("StateID") != 0).select("ID", "StateID").distinct(),
        ["ID"],
        F.col("StateID"),
        ["StateID"],
        "states",
    )


def language_names(languages: DataFrame) -> Column:
    """id → short name map of the (few) languages, as a scalar subquery."""
    return languages.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("ID", "ShortName")))).alias("names")
    ).scalar()


def field_classes(fields: DataFrame, column: str = "field") -> DataFrame:
    """Classes of every field name: attributes are custom (once, by their value field), the rest standard; an attribute
    with a negative id is custom and plugin.

    Malformed ids (with a comma) and formatted values give no field of their own.
    """
    field = F.col(column)
    ident = F.split_part(field, F.lit(":"), F.lit(1))
    is_value = field.contains(":Value")
    return (
        fields.where(~(is_value & ident.contains(",")) & ~field.contains(":FormattedValue"))
        .select(
            F.when(is_value, ident).otherwise(field).alias("name"),
            F.explode(
                F.when(is_value & field.contains("-"), F.array(F.lit("custom"), F.lit("plugin")))
                .when(is_value, F.array(F.lit("custom")))
                .otherwise(F.array(F.lit("standard")))
            ).alias("field_class"),
        )
        .distinct()
    )
