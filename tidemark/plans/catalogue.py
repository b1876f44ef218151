"""Attributes, classes, trees, and changes to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators import apply, cascade, catalog, evolve, tree
from tidemark.plans.fixtures import Fixtures, text
from tidemark.plans.registry import query


@query(
    "effective_attributes",
    """
WITH tok AS (SELECT ID, LanguageID, CAST(unnest(string_split(trim(ClassMapping), ' ')) AS BIGINT) AS ClassID
  FROM {fx_items} WHERE ID % 9 <> 0 UNION ALL SELECT ID, LanguageID, 0 FROM {fx_items} WHERE ID % 9 = 0
  UNION ALL SELECT ID, LanguageID, 200 + ID % 7 FROM {fx_items} WHERE ID % 4 = 1),
 pairs AS (SELECT DISTINCT ID, LanguageID, AttributeID FROM tok JOIN {fx_class_attributes} USING (ClassID)
  UNION SELECT ID, LanguageID, -5 FROM {fx_items})
SELECT ID, LanguageID, string_agg(CAST(AttributeID AS VARCHAR), ',' ORDER BY AttributeID) AS attribute_ids
FROM pairs WHERE AttributeID NOT IN (SELECT ID FROM {fx_class_kinds} WHERE _TypeID IN (0, 2, 3)) GROUP BY 1, 2""",
)
def effective_attributes(fx: Fixtures) -> DataFrame:
    classes = F.when(F.col("ID") % 9 == 0, F.lit("")).otherwise(F.col("ClassMapping"))
    # Every fourth item extends another one and adds that one's class.
    base = F.when(F.col("ID") % 4 == 1, F.format_string(" %d ", 200 + F.col("ID") % 7)).otherwise(F.lit(""))
    items = fx.items.withColumns({"ClassMapping": classes, "_ExtensionClassMapping": base})
    lists = ("ClassMapping", "_ExtensionClassMapping")
    effective = catalog.effective_attributes(items, fx.class_attributes, fx.class_kinds, [-5], lists)
    return catalog.with_effective_attributes(items, effective, lists).select(
        "ID", "LanguageID", F.array_join("attribute_ids", ",").alias("attribute_ids")
    )


@query("attrs_by_kind", "SELECT _TypeID, ID, Label FROM {fx_attributes} WHERE _TypeID IN (0, 2, 3)")
def attrs_by_kind(fx: Fixtures) -> DataFrame:
    kinds = [catalog.attributes_of_kind(fx.attributes, k) for k in catalog.SPECIAL_KINDS]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).select("_TypeID", "ID", "Label")


@query(
    "attribute_lookup",
    """
SELECT a.ID, a.Label, a.ParamA AS param_a, a.ParamB AS param_b,
 CASE WHEN a._TypeID > 0 THEN json_extract_string(a.PropertyValues, '$.unit') END AS unit,
 CASE WHEN a._TypeID > 0 THEN json_extract_string(a.PropertyValues, '$.decimals') END AS decimals,
 CASE WHEN k.AttributeID IS NULL THEN 0 ELSE 1 END AS by_key
FROM {fx_attributes} a LEFT JOIN (SELECT ExternalKey, max(ID) AS AttributeID FROM {fx_attributes}
 WHERE ExternalKey <> '' GROUP BY 1) k ON k.AttributeID = a.ID""",
)
def attribute_lookup(fx: Fixtures) -> DataFrame:
    keyed = catalog.ids_by_external_key(fx.attributes).select(F.col("AttributeID").alias("ID"), F.lit(1).alias("k"))
    return catalog.attribute_objects(fx.attributes).join(keyed, "ID", "left").select(
        "ID",
        "Label",
        F.col("params")["ParamA"].alias("param_a"),
        F.col("params")["ParamB"].alias("param_b"),
        F.col("properties")["unit"].alias("unit"),
        F.col("properties")["decimals"].alias("decimals"),
        F.coalesce("k", F.lit(0)).alias("by_key"),
    )


@query(
    "attr_children",
    """
SELECT ParentID, 0 AS part, string_agg(CAST(ID AS VARCHAR), ',' ORDER BY ID) AS children
FROM {fx_attributes} WHERE IsLink = 0 GROUP BY 1""",
)
def attr_children(fx: Fixtures) -> DataFrame:
    return catalog.children(fx.attributes).select(
        "ParentID", "part", F.array_join("children", ",").alias("children")
    )


@query(
    "attribute_tree",
    """
WITH RECURSIVE t AS (SELECT ID AS root, ID, 0 AS level FROM {fx_attributes} WHERE ParentID = 0 AND IsLink = 0
 UNION ALL SELECT t.root, a.ID, t.level + 1 FROM t JOIN {fx_attributes} a ON a.ParentID = t.ID AND a.IsLink = 0),
 two AS (SELECT ID AS root, ID, 0 AS level FROM {fx_attributes} WHERE IsFolder = 1
 UNION ALL SELECT a.ParentID, a.ID, 1 FROM {fx_attributes} a JOIN {fx_attributes} f ON f.ID = a.ParentID
 WHERE f.IsFolder = 1 AND a.IsLink = 0)
SELECT 'all' AS asked, root, ID, level FROM t UNION ALL SELECT 'one level', root, ID, level FROM two""",
)
def attribute_tree(fx: Fixtures) -> DataFrame:
    whole = tree.subtree(fx.attributes)
    roots = fx.attributes.where(F.col("IsFolder") == 1).select("ID")
    some = tree.subtree(fx.attributes, roots, depth=1)
    return whole.select(F.lit("all").alias("asked"), "root", "ID", "level").unionByName(
        some.select(F.lit("one level").alias("asked"), "root", "ID", "level")
    )


@query(
    "descendants",
    """
WITH RECURSIVE e AS (SELECT DISTINCT ParentID AS parent, ID AS child FROM {fx_items}),
 t AS (SELECT parent AS root, child AS ID, 1 AS level FROM e
 UNION ALL SELECT t.root, e.child, t.level + 1 FROM t JOIN e ON e.parent = t.ID)
SELECT root, count(*) FILTER (WHERE level = 1) AS children, count(*) FILTER (WHERE level <= 2) AS two_levels,
 count(*) AS all_levels, CAST(sum(ID) AS BIGINT) AS id_sum, CAST(max(level) AS INTEGER) AS depth FROM t GROUP BY 1""",
)
def descendants(fx: Fixtures) -> DataFrame:
    roots = fx.items.select(F.col("ParentID").alias("ID")).distinct()
    return tree.descendants(fx.items, roots).groupBy("root").agg(
        F.count_if(F.col("level") == 1).alias("children"),
        F.count_if(F.col("level") <= 2).alias("two_levels"),
        F.count(F.lit(1)).alias("all_levels"),
        F.sum("ID").alias("id_sum"),
        F.max("level").alias("depth"),
    )


@query(
    "workflow_states",
    """
SELECT WorkflowID AS ID, 0 AS part, string_agg(CAST(StateID AS VARCHAR), ',' ORDER BY StateID) AS states FROM (
 SELECT DISTINCT o_custkey AS WorkflowID, o_orderkey % 8 AS StateID FROM orders) WHERE StateID <> 0 GROUP BY 1""",
)
def workflow_states(fx: Fixtures) -> DataFrame:
    records = fx.table("orders").select(F.col("o_custkey").alias("ID"), (F.col("o_orderkey") % 8).alias("StateID"))
    return catalog.workflow_states(records).select("ID", "part", F.array_join("states", ",").alias("states"))


def configuration_changes(fx: Fixtures) -> DataFrame:
    """Changes as attribute definitions of the suppliers' ids."""
    event = F.col("event_id")
    envelope = F.when(event % 4 == 0, "Reference").when(event % 4 == 1, "Subtable").otherwise("Item")
    fields = F.create_map(
        F.lit("Label"), F.concat(F.lit("L"), text(event)),
        F.lit("ParentID"), F.when(event % 3 == 0, F.lit("")).otherwise(text(100 + event % 25)),
        F.lit("IsFolder"), text(F.when(event % 10 == 3, 1).otherwise(0)),
        F.lit("_SubAttributes"), F.concat(text(event % 6), F.lit(", "), text(event % 5)),
    )
    return fx.changes.select(
        (F.col("ID") + 950).alias("ID"), "seq", "event_id", "Action", envelope.alias("envelope_key"),
        fields.alias("fields"),
    )


@query(
    "config_apply",
    """
WITH c AS (SELECT *, ID + 950 AS aid, row_number() OVER (PARTITION BY ID ORDER BY seq DESC, event_id DESC) AS rn
  FROM {fx_changes}),
 last AS (SELECT * FROM c WHERE rn = 1),
 state AS (
 SELECT a.ID, a.Label, a.ParentID, a.IsFolder, a.IsLink, a._TypeID, a.ExternalKey, a.PropertyValues, a.ParamA, a.ParamB
  FROM {fx_attributes} a
  WHERE NOT EXISTS (SELECT 1 FROM last WHERE aid = a.ID)
 UNION ALL SELECT aid, concat('L', CAST(event_id AS VARCHAR)),
  CASE WHEN event_id % 3 = 0 THEN 0 ELSE 100 + event_id % 25 END, CASE WHEN event_id % 10 = 3 THEN 1 ELSE 0 END, 0,
  CASE WHEN event_id % 4 = 0 THEN 2 WHEN event_id % 4 = 1 THEN 3 WHEN event_id % 10 = 3 THEN 0 ELSE 1 END,
  '', '', '', '' FROM last WHERE Action <> 2),
 cols AS (
 SELECT DISTINCT 'item' AS store, aid AS AttributeID FROM c WHERE event_id % 4 IN (2, 3) AND event_id % 10 <> 3
 UNION SELECT CASE event_id % 4 WHEN 0 THEN 'reference' ELSE 'subtable' END, event_id % 6 FROM c WHERE event_id % 4 < 2
 UNION SELECT CASE event_id % 4 WHEN 0 THEN 'reference' ELSE 'subtable' END, event_id % 5 FROM c WHERE event_id % 4 < 2)
SELECT 'attribute' AS kind, CAST(ID AS BIGINT) AS ID, Label, CAST(ParentID AS BIGINT) AS ParentID,
 CAST(IsFolder AS INTEGER) AS IsFolder, CAST(_TypeID AS INTEGER) AS type_id, ExternalKey, PropertyValues, ParamA, ParamB
 FROM state
UNION ALL SELECT store, AttributeID, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM cols""",
)
def config_apply(fx: Fixtures) -> DataFrame:
    changes = configuration_changes(fx)
    state = apply.apply_configuration(fx.attributes, changes)
    none, further = F.lit(None), ["ExternalKey", "PropertyValues", "ParamA", "ParamB"]
    return state.select(
        F.lit("attribute").alias("kind"), "ID", "Label", "ParentID", "IsFolder", F.col("_TypeID").alias("type_id"), *further
    ).unionByName(
        apply.registered_columns(changes).select(
            F.col("store").alias("kind"), F.col("AttributeID").alias("ID"), none.cast("string").alias("Label"),
            none.cast("bigint").alias("ParentID"), none.cast("int").alias("IsFolder"), none.cast("int").alias("type_id"),
            *[none.cast("string").alias(c) for c in further],
        )
    )


@query(
    "mapping_apply",
    """
WITH m AS (SELECT seq, event_id, CASE WHEN Action = 2 AND event_id % 250 = 0 THEN -1 ELSE ID % 40 END AS cls,
  [event_id % 30, event_id % 17] AS attrs FROM {fx_changes}),
 cut AS (SELECT max(seq * 1000000000 + event_id) AS pos FROM m WHERE cls = -1)
SELECT DISTINCT cls AS ClassID, a AS AttributeID FROM (
 SELECT cls, unnest(attrs) AS a, seq * 1000000000 + event_id AS pos FROM m WHERE cls <> -1)
WHERE pos > (SELECT coalesce(pos, -1) FROM cut)
UNION SELECT ClassID, AttributeID FROM {fx_class_attributes} WHERE (SELECT pos FROM cut) IS NULL""",
)
def mapping_apply(fx: Fixtures) -> DataFrame:
    event = F.col("event_id")
    emptied = (F.col("Action") == fixed.ACTION_DELETE) & (event % 250 == 0)
    changes = fx.changes.select(
        F.when(emptied, -1).otherwise(F.col("ID") % 40).alias("ID"), "seq", "event_id",
        F.concat(text(event % 30), F.lit(", "), text(event % 17)).alias("Message"),
    )
    return apply.apply_mapping(fx.class_attributes, changes)


@query(
    "schema_evolve",
    """
SELECT v.ID, v.LanguageID, max(CASE WHEN AttributeID = 13 THEN Value END) AS v13,
 max(CASE WHEN AttributeID = 43 THEN FormattedValue END) AS f43, NULL AS Segment, count(*) AS n
FROM {fx_item_values} v WHERE AttributeID <> 44 GROUP BY 1, 2
UNION ALL SELECT c_custkey, 2, NULL, NULL, c_mktsegment, 0 FROM customer""",
)
def schema_evolve(fx: Fixtures) -> DataFrame:
    attributes = fx.spark.sql("SELECT * FROM VALUES (44L, 0), (43L, 1), (13L, 0) AS t(ID, IsLink)")
    deleted = fx.spark.sql("SELECT * FROM VALUES (44L), (43L) AS t(ID)")
    kept = cascade.drop_attributes(fx.items.select("ID", "LanguageID", "attrs"), attributes, deleted)
    grown = evolve.evolve(
        kept.withColumn("Dropped", F.lit(1)), fx.customer_items.select("ID", "LanguageID", "Segment"), ("Dropped",)
    )
    counted = grown.withColumn("n", F.coalesce(F.size("attrs"), F.lit(0)).cast("bigint"))
    return evolve.wide(counted, [13, 43]).select(
        "ID", "LanguageID", F.col("`13:Value`").alias("v13"), F.col("`43:FormattedValue`").alias("f43"), "Segment", "n"
    )
