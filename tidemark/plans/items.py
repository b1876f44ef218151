"""Item filters, lookups and values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.api import Catalogue
from tidemark.functions.maps import formatted_values, standard_map, values
from tidemark.functions.text import id_list
from tidemark.operators import assemble, catalog, evolve, language
from tidemark.operators.criteria import Criteria, changed_since
from tidemark.plans.fixtures import Fixtures, micros, text
from tidemark.plans.registry import query

DEFAULT_LANGUAGE = 2
STANDARD = ["ID", "Label", "ParentID", "StateID", "CreationDate"]


def matching(items: DataFrame, cases: dict[str, Criteria]) -> DataFrame:
    """(case_name, ID) of several criteria in one scan."""
    names = [F.when(c.to_column(DEFAULT_LANGUAGE), F.lit(name)) for name, c in cases.items()]
    hits = F.filter(F.array(*names), lambda n: n.isNotNull())
    return items.select(F.explode(hits).alias("case_name"), "ID")


def catalogue(fx: Fixtures) -> Catalogue:
    return Catalogue(fx.items, fx.languages, fx.attributes, fx.class_attributes, fx.references, fx.subtables)


@query(
    "items_by_filter",
    """
WITH d AS (SELECT * FROM {fx_items} WHERE LanguageID = 2),
 hits AS (
 SELECT 'ids' AS case_name, ID FROM d WHERE ID IN (3, 5, 70, 71)
 UNION ALL SELECT 'parent', ID FROM d WHERE ParentID = 7
 UNION ALL SELECT 'parent above', ID FROM d WHERE ParentID > 30 AND IsFolder = 1
 UNION ALL SELECT 'changed', ID FROM d WHERE LastChange = TIMESTAMP '1999-02-05 00:00:00'
 UNION ALL SELECT 'short name', ID FROM {fx_items} WHERE LanguageShortName = 'fr' AND AuthorID = 3
 UNION ALL SELECT 'language', ID FROM {fx_items} WHERE LanguageID = 1 AND Author = 'user4' AND CheckoutUser = 2
 UNION ALL SELECT 'label', ID FROM d WHERE Label = 'blue ring [de]'
 UNION ALL SELECT 'key', ID FROM d WHERE ExternalKey = 'P-17'
 UNION ALL SELECT 'copy', ID FROM d WHERE CopyOf = 2 AND WorkflowID = 1
 UNION ALL SELECT 'many ids', ID FROM d WHERE ID BETWEEN 10 AND 1509
 UNION ALL SELECT 'at most', ID FROM d WHERE StateID <= 3
 UNION ALL SELECT 'at least', ID FROM d WHERE CreationDate >= TIMESTAMP '1998-02-15 00:00:00'
 UNION ALL SELECT 'like', ID FROM d WHERE Label LIKE 'b%e ring%'
 UNION ALL SELECT 'contains', ID FROM d WHERE contains(ExternalKey, '-1')
 UNION ALL SELECT 'in', ID FROM d WHERE WorkflowID IN (1, 3)
 UNION ALL SELECT 'in text', ID FROM d WHERE StateID IN (5, 7)
 UNION ALL SELECT 'from states', ID FROM d WHERE IsFolder = 1 AND ID IN (SELECT ID FROM {fx_changes} WHERE Action = 2))
SELECT case_name, ID, CAST(1 AS BIGINT) AS n FROM hits
UNION ALL SELECT concat('count of ', case_name), NULL, count(*) FROM hits GROUP BY case_name""",
)
def items_by_filter(fx: Fixtures) -> DataFrame:
    cases = {
        "ids": Criteria().item_ids([3, 5]).item_ids([70, 71]),
        "parent": Criteria().parent_id(7),
        "parent above": Criteria().parent_id(30, ">").is_folder(1),
        "changed": Criteria().last_change("1999-02-05 00:00:00"),
        "short name": Criteria().language_short_name("fr").author_id(3),
        "language": Criteria().language_by_id(1).author("user4").checkout_user(2),
        "label": Criteria().label("blue ring [de]"),
        "key": Criteria().external_key("P-17"),
        "copy": Criteria().copy_of(2).workflow_id(1),
        "many ids": Criteria().item_ids(range(10, 1510)),
        "at most": Criteria().state_id(3, " <= "),
        "at least": Criteria().creation_date("1998-02-15 00:00:00", ">="),
        "like": Criteria().label("b%e ring%", " LIKE  "),
        "contains": Criteria().external_key("-1", "contains"),
        "in": Criteria().workflow_id([1, 3], "IN"),
        "in text": Criteria().state_id("(5, 7)", " IN "),
    }
    ids = fx.changes.where(F.col("Action") == fixed.ACTION_DELETE).select("ID")
    listed = Criteria().is_folder(1).item_ids(ids).apply(fx.items, DEFAULT_LANGUAGE)
    hits = matching(fx.items, cases).unionByName(listed.select(F.lit("from states").alias("case_name"), "ID"))
    counts = hits.groupBy("case_name").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit("count of "), "case_name").alias("case_name"), F.lit(None).cast("bigint").alias("ID"), "n"
    )
    return hits.withColumn("n", F.lit(1).cast("bigint")).unionByName(counts)


@query(
    "filter_workflow_state",
    "SELECT ID, StateID, WorkflowID FROM {fx_items} WHERE LanguageID = 2 AND StateID < 20 AND WorkflowID = 3",
)
def filter_workflow_state(fx: Fixtures) -> DataFrame:
    found = Criteria().state_id(20, "<").workflow_id(3).apply(fx.items, DEFAULT_LANGUAGE)
    return found.select("ID", "StateID", "WorkflowID")


@query(
    "filter_class_token",
    """
SELECT ID, CAST(string_split(trim(ClassMapping), ' ')[1] AS BIGINT) AS first_class, ClassMapping FROM {fx_items}
WHERE LanguageID = 2 AND list_contains(string_split(trim(ClassMapping), ' '), '203')""",
)
def filter_class_token(fx: Fixtures) -> DataFrame:
    found = Criteria().class_id(203).apply(fx.items, DEFAULT_LANGUAGE)
    return found.select("ID", id_list("ClassMapping")[0].alias("first_class"), "ClassMapping")


@query(
    "filter_ancestor_token",
    """
SELECT ID, LanguageID FROM {fx_items}
WHERE LanguageID = 3 AND list_contains(string_split(trim(_Parents), ' '), '12')""",
)
def filter_ancestor_token(fx: Fixtures) -> DataFrame:
    found = Criteria().ancestor(12).language_by_id(3).apply(fx.items, DEFAULT_LANGUAGE)
    return found.select("ID", "LanguageID")


@query(
    "filter_custom_attr",
    """
SELECT v.ID, i.Label FROM {fx_item_values} v JOIN {fx_items} i ON i.ID = v.ID AND i.LanguageID = v.LanguageID
WHERE v.LanguageID = 2 AND v.AttributeID = 44 AND v.FormattedValue = '16 kg' AND i.Label LIKE 'b%'""",
)
def filter_custom_attr(fx: Fixtures) -> DataFrame:
    found = Criteria().custom_attribute(44, "16 kg").user_defined("Label LIKE 'b%'").apply(fx.items, DEFAULT_LANGUAGE)
    return found.select("ID", "Label")


@query(
    "updated_since",
    """
SELECT 'all' AS case_name, ID FROM {fx_order_items} WHERE _LastWritten > TIMESTAMP '2000-06-01 00:00:00'
UNION ALL SELECT 'criteria', ID FROM {fx_order_items} WHERE _LastWritten > TIMESTAMP '2000-06-01 00:00:00'
 AND StateID < 50 AND Label = '2-HIGH' AND WorkflowID = 1""",
)
def updated_since(fx: Fixtures) -> DataFrame:
    since = "2000-06-01 00:00:00"
    plain = changed_since(fx.order_items, "_LastWritten", since, None, DEFAULT_LANGUAGE)
    criteria = Criteria().state_id(50, "<").label("2-HIGH").workflow_id(1)
    some = changed_since(fx.order_items, "_LastWritten", since, criteria, DEFAULT_LANGUAGE)
    return plain.select(F.lit("all").alias("case_name"), "ID").unionByName(
        some.select(F.lit("criteria").alias("case_name"), "ID")
    )


@query(
    "created_since",
    """
SELECT ID, epoch_us(_InsertTime) AS created FROM {fx_order_items}
WHERE _InsertTime > TIMESTAMP '2001-01-15 00:00:00' AND CopyOf = 3""",
)
def created_since(fx: Fixtures) -> DataFrame:
    found = changed_since(
        fx.order_items, "_InsertTime", "2001-01-15 00:00:00", Criteria().copy_of(3), DEFAULT_LANGUAGE
    )
    return found.select("ID", micros("_InsertTime").alias("created"))


@query(
    "item_lookup",
    """
SELECT 'id' AS asked, ID, LanguageShortName, Label FROM {fx_items} WHERE ID = 42
UNION ALL SELECT 'key', ID, LanguageShortName, Label FROM {fx_items} WHERE ID IN (
 SELECT ID FROM {fx_items} WHERE LanguageID = 2 AND ExternalKey = 'P-99')
UNION ALL SELECT 'state', ID, LanguageShortName, Label FROM {fx_order_items} WHERE StateID = 40""",
)
def item_lookup(fx: Fixtures) -> DataFrame:
    items, records = catalogue(fx), Catalogue(fx.order_items, fx.languages)
    found = {
        "id": items.item_by_id(42),
        "key": items.item_by_external_key("P-99"),
        "state": records.record_by_state(40),
    }
    parts = [df.select(F.lit(k).alias("asked"), "ID", "LanguageShortName", "Label") for k, df in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "items_batch",
    """
SELECT ID, LanguageID, Label FROM {fx_items} i WHERE LanguageID IN (1, 3)
 AND EXISTS (SELECT 1 FROM {fx_changes} c WHERE c.ID = i.ID)""",
)
def items_batch(fx: Fixtures) -> DataFrame:
    return catalogue(fx).items_in_batch(fx.changes.select("ID"), [1, 3], ["ID", "LanguageID", "Label"])


@query(
    "lookup_view",
    """
SELECT 'StateID' AS field, LanguageID, StateID AS value, ID FROM {fx_items} WHERE StateID IS NOT NULL
UNION ALL SELECT 'ParentID', LanguageID, ParentID, ID FROM {fx_items} WHERE ParentID IS NOT NULL""",
)
def lookup_view(fx: Fixtures) -> DataFrame:
    parts = [
        evolve.lookup_table(fx.items, f, "Pdmarticle").select(
            F.lit(f).alias("field"), "LanguageID", F.col(f).alias("value"), "ID"
        )
        for f in ("StateID", "ParentID")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "language_lookup",
    """
SELECT i.LanguageShortName, l.ID AS language_id, (SELECT ID FROM {fx_languages} WHERE IsDefault = 1) AS default_id,
 (SELECT ShortName FROM {fx_languages} WHERE ID = 3) AS third, count(*) AS n
FROM {fx_items} i JOIN {fx_languages} l ON l.ShortName = i.LanguageShortName GROUP BY 1, 2""",
)
def language_lookup(fx: Fixtures) -> DataFrame:
    from tidemark.functions.maps import inverted

    names = catalog.language_names(fx.languages)
    return fx.items.groupBy("LanguageShortName").agg(F.count(F.lit(1)).alias("n")).select(
        "LanguageShortName",
        inverted(names)[F.col("LanguageShortName")].alias("language_id"),
        language.resolve_language(fx.languages).alias("default_id"),
        F.element_at(names, F.lit(3)).alias("third"),
        "n",
    )


@query(
    "item_parent",
    """
SELECT i.ID, i.LanguageID, p.Label AS parent_Label, p.ExternalKey AS parent_ExternalKey FROM {fx_items} i
LEFT JOIN {fx_items} p ON p.ID = i.ParentID AND p.LanguageID = i.LanguageID""",
)
def item_parent(fx: Fixtures) -> DataFrame:
    return assemble.with_parent(fx.items, "Label", "ExternalKey").select(
        "ID", "LanguageID", "parent_Label", "parent_ExternalKey"
    )


@query(
    "item_values_long",
    """
SELECT ID, LanguageID, CAST(AttributeID AS VARCHAR) AS field, Value, FormattedValue FROM {fx_item_values}
UNION ALL SELECT ID, LanguageID, field, v, v FROM (
 SELECT ID, LanguageID, unnest(['ID', 'Label', 'ParentID']) AS field,
 unnest([CAST(ID AS VARCHAR), Label, CAST(ParentID AS VARCHAR)]) AS v FROM {fx_items})""",
)
def item_values_long(fx: Fixtures) -> DataFrame:
    return assemble.values_long(fx.items, ["ID", "Label", "ParentID"])


@query(
    "value_by_field",
    """
SELECT i.ID, i.LanguageID, CASE i.ID % 4 WHEN 0 THEN b.Value WHEN 1 THEN i.Label WHEN 2 THEN s.Value ELSE NULL END
 AS value, CASE i.ID % 4 WHEN 0 THEN b.FormattedValue WHEN 1 THEN i.Label WHEN 2 THEN s.FormattedValue ELSE NULL END
 AS formatted
FROM {fx_items} i
JOIN {fx_item_values} b ON b.ID = i.ID AND b.LanguageID = i.LanguageID AND b.AttributeID = 43
JOIN {fx_item_values} s ON s.ID = i.ID AND s.LanguageID = i.LanguageID AND s.AttributeID = 44""",
)
def value_by_field(fx: Fixtures) -> DataFrame:
    asked = F.element_at(
        F.array(F.lit("43"), F.lit("Label"), F.lit("44"), F.lit("-7")), (F.col("ID") % 4).cast("int") + 1
    )
    standard = standard_map(["Label", "ExternalKey"])
    value = assemble.field_value(asked, F.col("attrs"), standard)
    formatted = assemble.field_value(asked, F.col("attrs"), standard, "formatted")
    return fx.items.select("ID", "LanguageID", value.alias("value"), formatted.alias("formatted"))


@query(
    "attr_value_maps",
    """
SELECT ID, LanguageID, string_agg(concat(AttributeID, '=', Value), ';' ORDER BY AttributeID) AS value_map,
 string_agg(concat(AttributeID, '=', FormattedValue), ';' ORDER BY AttributeID) AS formatted_map
FROM {fx_item_values} GROUP BY 1, 2""",
)
def attr_value_maps(fx: Fixtures) -> DataFrame:
    def rendered(m: Column) -> Column:
        return F.array_join(
            F.transform(F.sort_array(F.map_entries(m)), lambda e: F.concat(text(e["key"]), F.lit("="), e["value"])), ";"
        )

    return fx.items.select(
        "ID", "LanguageID", rendered(values("attrs")).alias("value_map"),
        rendered(formatted_values("attrs")).alias("formatted_map"),
    )


@query(
    "standard_map",
    """
SELECT ID, LanguageID, unnest(['ID', 'Label', 'ParentID', 'StateID', 'CreationDate']) AS field,
 unnest([CAST(ID AS VARCHAR), Label, CAST(ParentID AS VARCHAR), CAST(StateID AS VARCHAR),
  strftime(CreationDate, '%Y-%m-%d %H:%M:%S')]) AS value FROM {fx_items}""",
)
def standard_values(fx: Fixtures) -> DataFrame:
    return fx.items.select("ID", "LanguageID", F.explode(standard_map(STANDARD)).alias("field", "value"))


@query(
    "field_classes",
    """
SELECT DISTINCT f.name, f.field_class FROM (
 SELECT CAST(s_suppkey AS VARCHAR) AS name, 'custom' AS field_class FROM supplier
 UNION ALL SELECT concat('-', CAST(s_suppkey AS VARCHAR)), unnest(['custom', 'plugin']) FROM supplier
  WHERE s_suppkey % 5 = 0
 UNION ALL SELECT s_name, 'standard' FROM supplier) f""",
)
def field_classes(fx: Fixtures) -> DataFrame:
    key = text("s_suppkey")
    names = F.array(
        F.concat(key, F.lit(":Value")),
        F.concat(key, F.lit(":FormattedValue")),
        F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("-"), key, F.lit(":Value"))).otherwise(
            F.concat(key, F.lit(",9:Value"))
        ),
        F.col("s_name"),
    )
    return catalog.field_classes(fx.table("supplier").select(F.explode(names).alias("field")))


@query(
    "value_by_external_key",
    """
WITH k AS (SELECT concat('K-', CAST(p_size % 3 AS VARCHAR)) AS ExternalKey, max(CASE p_size % 3 WHEN 0 THEN 13 WHEN 1 THEN 43 ELSE 44 END)
 AS AttributeID FROM part GROUP BY 1)
SELECT ID, LanguageID, ExternalKey, Value, FormattedValue FROM {fx_item_values} v JOIN k USING (AttributeID)""",
)
def value_by_external_key(fx: Fixtures) -> DataFrame:
    size = F.col("p_size") % 3
    named = fx.table("part").select(
        F.concat(F.lit("K-"), text(size)).alias("ExternalKey"),
        F.when(size == 0, 13).when(size == 1, 43).otherwise(44).cast("bigint").alias("ID"),
    )
    return assemble.values_by_external_key(fx.items, catalog.ids_by_external_key(named))


@query(
    "lang_bundle",
    """
SELECT ID, string_agg(concat(LanguageID, ':', Label), ';' ORDER BY LanguageID) AS labels,
 max(CASE WHEN LanguageID = 2 THEN Label END) AS default_label FROM {fx_items} GROUP BY 1""",
)
def lang_bundle(fx: Fixtures) -> DataFrame:
    bundled = language.bundle(fx.items, F.struct("Label"))
    entries = F.transform(
        F.map_entries("languages"), lambda e: F.concat(text(e["key"]), F.lit(":"), e["value"]["Label"])
    )
    return bundled.select(
        "ID",
        F.array_join(F.sort_array(entries), ";").alias("labels"),
        F.col("languages")[F.lit(2)]["Label"].alias("default_label"),
    )


@query(
    "lang_overlay",
    """
SELECT i.ID, i.LanguageID, f.name, CASE f.name WHEN 'Label' THEN i.Label WHEN 'ExternalKey' THEN
  CASE WHEN i.ID % 3 = 0 THEN 'shared' ELSE i.ExternalKey END ELSE 'global' END AS value
FROM {fx_items} i CROSS JOIN (SELECT * FROM (VALUES ('Label'), ('ExternalKey'), ('Origin')) AS t(name)) f
WHERE f.name <> 'Origin' OR i.ID % 3 = 0""",
)
def lang_overlay(fx: Fixtures) -> DataFrame:
    own = fx.items.select(
        "ID", "LanguageID", F.create_map(F.lit("Label"), "Label", F.lit("ExternalKey"), "ExternalKey").alias("fields")
    )
    shared = fx.table("part").where((F.col("p_partkey") + 1) % 3 == 0).select(
        (F.col("p_partkey") + 1).alias("ID"),
        F.lit(0).cast("bigint").alias("LanguageID"),
        F.create_map(
            F.lit("LanguageID"), F.lit("0"), F.lit("ExternalKey"), F.lit("shared"), F.lit("Origin"), F.lit("global")
        ).alias("fields"),
    )
    return language.overlay(own.unionByName(shared)).select(
        "ID", "LanguageID", F.explode("fields").alias("name", "value")
    )


@query(
    "lang_fanout",
    """
WITH langs AS (SELECT p_partkey + 1 AS ID, CAST(l.ID AS BIGINT) AS LanguageID FROM part CROSS JOIN {fx_languages} l
 WHERE l.ID < 3 OR p_partkey % 2 = 0)
SELECT r.l_partkey + 1 AS ItemID, r.line_id AS ReferenceID, g.LanguageID FROM {fx_lines} r
 JOIN langs g ON g.ID = r.l_partkey + 1 WHERE r.l_linenumber % 2 = 0
UNION ALL SELECT l_partkey + 1, line_id, 3 FROM {fx_lines} WHERE l_linenumber % 2 <> 0""",
)
def lang_fanout(fx: Fixtures) -> DataFrame:
    odd_third = (F.col("LanguageID") < 3) | ((F.col("ID") - 1) % 2 == 0)
    languages = fx.items.where(odd_third).select("ID", "LanguageID")
    rows = fx.lines.select(
        (F.col("l_partkey") + 1).alias("ItemID"),
        F.col("line_id").alias("ReferenceID"),
        F.when(F.col("l_linenumber") % 2 == 0, 0).otherwise(3).cast("bigint").alias("LanguageID"),
    )
    return language.fan_out(rows, languages)


@query(
    "lang_pivot",
    """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '1' ELSE CAST(event_id % 3 AS VARCHAR) END AS row_key, 'Name' AS name,
 event_type AS value FROM events
UNION ALL SELECT event_id, concat('States_', CAST(user_id AS VARCHAR)), 'StateID', CAST(user_id AS VARCHAR) FROM events
UNION ALL SELECT event_id, concat('States_', CAST(user_id AS VARCHAR)), 'Label', event_type FROM events
UNION ALL SELECT event_id, CAST(event_id % 3 AS VARCHAR), 'LanguageID', CAST(event_id % 3 AS VARCHAR) FROM events
 WHERE event_id % 3 <> 0""",
)
def lang_pivot(fx: Fixtures) -> DataFrame:
    lang = F.when(F.col("event_id") % 3 != 0, text(F.col("event_id") % 3))
    fields = F.when(lang.isNull(), F.create_map(F.lit("Name"), "event_type", F.lit("_States"), F.lit("[]"))).otherwise(
        F.create_map(F.lit("LanguageID"), lang, F.lit("Name"), F.col("event_type"))
    )
    states = F.array(F.create_map(F.lit("StateID"), text("user_id"), F.lit("Label"), F.col("event_type")))
    rows = fx.table("events").select(
        "event_id", F.array(F.struct(fields.alias("fields"), states.alias("states"))).alias("rows")
    )
    return language.pivot_records(rows, ["event_id"]).select(
        "event_id", "row_key", F.explode("fields").alias("name", "value")
    )
