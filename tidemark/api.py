"""The read API over a catalogue of item, reference, nested-table, attribute and language tables."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.maps import VALUE_FIELD, formatted_values, standard_map, values
from tidemark.operators import assemble, catalog, tree
from tidemark.operators.criteria import Criteria, changed_since


@dataclass(frozen=True)
class Catalogue:
    """One item type of the store. Every method returns a lazy DataFrame, so calls compose into one plan."""

    items: DataFrame
    languages: DataFrame
    attributes: DataFrame | None = None
    class_attributes: DataFrame | None = None
    references: DataFrame | None = None
    subtables: DataFrame | None = None
    item_type: str = "Pdmarticle"

    @cached_property
    def default_language(self) -> int | None:
        """Id of the default language; record types have none."""
        if self.item_type in fixed.RECORD_TYPES:
            return None
        row = self.languages.where(F.col("IsDefault") == 1).select("ID").first()
        return None if row is None else row[0]

    # --- items ------------------------------------------------------------------------------------------
    def item_by_id(self, item_id: int) -> DataFrame:
        """The item in all languages."""
        return self.items.where(F.col("ID") == item_id)

    def item_by_external_key(self, key: str) -> DataFrame:
        """The item, found in the default language, in all languages."""
        found = Criteria().external_key(key).apply(self.items, self.default_language).select("ID").distinct()
        return self.items.join(found, "ID", "left_semi")

    def record_by_state(self, state_id: int) -> DataFrame:
        return self.items.where(F.col("StateID") == state_id)

    def item_ids(self, criteria: Criteria) -> DataFrame:
        return self.items_by_filter(criteria).select("ID").distinct()

    def items_by_filter(self, criteria: Criteria) -> DataFrame:
        return criteria.apply(self.items, self.default_language)

    def iterate(self, criteria: Criteria, languages: list[int] | None = None) -> Iterator[Row]:
        """Items one by one, partition after partition, each with its languages."""
        rows = self.items.join(self.item_ids(criteria), "ID", "left_semi")
        if languages is not None:
            rows = rows.where(F.col("LanguageID").isin(languages))
        from tidemark.operators.language import bundle

        payload = F.struct(*[c for c in self.items.columns if c not in ("ID", "LanguageID")])
        return bundle(rows, payload).toLocalIterator()

    def updated_since(self, since: str, criteria: Criteria | None = None) -> DataFrame:
        changed = changed_since(self.items, "_LastWritten", since, criteria, self.default_language)
        return changed.select("ID").distinct()

    def created_since(self, since: str, criteria: Criteria | None = None) -> DataFrame:
        changed = changed_since(self.items, "_InsertTime", since, criteria, self.default_language)
        return changed.select("ID").distinct()

    def items_in_batch(self, ids: DataFrame, languages: list[int], columns: list[str] | None = None) -> DataFrame:
        rows = self.items.where(F.col("LanguageID").isin(languages)).join(ids, "ID", "left_semi")
        return rows.select(*columns) if columns else rows

    def descendants(self, item_id: int, level: int = 1) -> DataFrame:
        root = self.items.sparkSession.range(item_id, item_id + 1).select(F.col("id").alias("ID"))
        return tree.descendants(self.items, root, level).select("ID")

    def parents(self, *fields: str) -> DataFrame:
        return assemble.with_parent(self.items, *fields)

    # --- assembly ---------------------------------------------------------------------------------------
    @property
    def class_columns(self) -> tuple[str, ...]:
        """Columns with class lists: a view item adds the classes of the item it extends."""
        extended = self.item_type.endswith(fixed.VIEW_SUFFIX) and "_ExtensionClassMapping" in self.items.columns
        return ("ClassMapping", "_ExtensionClassMapping") if extended else ("ClassMapping",)

    @cached_property
    def plugin_ids(self) -> list[int]:
        """Plugin attributes (negative ids) of the store; they belong to every item. A column each, so a short list."""
        if "attrs" not in self.items.columns:
            return []
        ids = self.items.select(F.explode(F.map_keys("attrs")).alias("id")).where(F.col("id") < 0).distinct()
        return sorted(r["id"] for r in ids.collect())

    def effective_attributes(self) -> DataFrame:
        return catalog.effective_attributes(
            self.items, self.class_attributes, self.attributes, self.plugin_ids, self.class_columns
        )

    def _children(self, rows: DataFrame, kind: int) -> DataFrame:
        assigned = catalog.assigned_of_kind(
            self.items, self.class_attributes, self.attributes, kind, self.plugin_ids, self.class_columns
        )
        return assemble.children_of_items(self.items, rows, assigned, self.class_columns)

    def item_references(self) -> DataFrame:
        return self._children(self.references, fixed.KIND_REFERENCE)

    def item_subtables(self) -> DataFrame:
        return self._children(self.subtables, fixed.KIND_SUBTABLE)

    def assembled(self) -> DataFrame:
        """Items with their assigned values, references and nested rows."""
        return assemble.assembled_items(
            self.items, self.class_attributes, self.attributes, self.references, self.subtables, self.plugin_ids,
            self.class_columns,
        )

    def values(self, standard: list[str]) -> DataFrame:
        return assemble.values_long(self.items, standard)

    def value(self, field: str, standard: list[str], formatted: bool = False) -> DataFrame:
        part = "formatted" if formatted else "value"
        return assemble.value_of(self.items, field, standard_map(standard), part)

    def value_by_external_key(self, key: str) -> DataFrame:
        keys = catalog.ids_by_external_key(self.attributes).where(F.col("ExternalKey") == key)
        return assemble.values_by_external_key(self.items, keys)

    def value_maps(self) -> DataFrame:
        return self.items.select(
            "ID", "LanguageID", values("attrs").alias("values"), formatted_values("attrs").alias("formatted")
        )

    # --- attributes -------------------------------------------------------------------------------------
    def attribute(self, attribute_id: int) -> DataFrame:
        return catalog.attribute_objects(self.attributes).where(F.col("ID") == attribute_id)

    def attribute_by_external_key(self, key: str) -> DataFrame:
        found = catalog.ids_by_external_key(self.attributes).where(F.col("ExternalKey") == key)
        return catalog.attribute_objects(self.attributes).join(
            found.select(F.col("AttributeID").alias("ID")), "ID", "left_semi"
        )

    def attributes_of_class(self, class_id: int) -> DataFrame:
        return catalog.attributes_by_class(self.class_attributes, class_id)

    def attribute_tree(self, attribute_id: int = 0, depth: int = 0) -> DataFrame:
        spark = self.attributes.sparkSession
        root = None if attribute_id == 0 else spark.range(attribute_id, attribute_id + 1).select(F.col("id").alias("ID"))
        return tree.subtree(self.attributes, root, depth)

    def fields(self, names: DataFrame | None = None) -> DataFrame:
        """Field classes of the store: its columns plus the attribute ids found in the rows."""
        if names is None:
            columns = [c for c in self.items.columns if c != "attrs"]
            names = self.items.sparkSession.createDataFrame([(c,) for c in columns], "field string")
            if "attrs" in self.items.columns:
                ids = self.items.select(F.explode(F.map_keys("attrs")).alias("id")).distinct()
                names = names.unionByName(ids.select(F.concat("id", F.lit(":Value")).alias("field")))
        return catalog.field_classes(names)

    # --- languages --------------------------------------------------------------------------------------
    def language_by_id(self, language_id: int) -> DataFrame:
        return self.languages.where(F.col("ID") == language_id)

    def language_by_short_name(self, short_name: str) -> DataFrame:
        return self.languages.where(F.col("ShortName") == short_name)

    def language_names(self) -> Column:
        return catalog.language_names(self.languages)


__all__ = ["Catalogue", "Criteria", "VALUE_FIELD"]
