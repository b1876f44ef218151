"""References, nested tables, and changes to items and what hangs off them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.text import comma_list
from tidemark.operators import apply, assemble, cascade, catalog, language
from tidemark.plans.fixtures import Fixtures, text
from tidemark.plans.registry import query
from tidemark.session import cut_lineage
from tidemark.sources.changes import read_delete


def listed(rows: Column, render) -> Column:
    """Array of structs as text."""
    return F.array_join(F.transform(rows, render), ",")


@query(
    "item_references",
    """
SELECT r.ItemID, r.AttributeID, r.ReferenceID, r.TargetID, i.Label FROM {fx_references} r
JOIN {fx_order_items} i ON i.ID = r.ItemID AND i.LanguageID = r.LanguageID
WHERE EXISTS (SELECT 1 FROM {fx_class_attributes} c WHERE c.ClassID = CAST(trim(i.ClassMapping) AS BIGINT)
 AND c.AttributeID = r.AttributeID)""",
)
def item_references(fx: Fixtures) -> DataFrame:
    assigned = catalog.assigned_of_kind(
        fx.order_items, fx.class_attributes, fx.class_kinds, fixed.KIND_REFERENCE
    )
    rows = assemble.children_of_items(fx.order_items, fx.references, cut_lineage(assigned), keep=("Label",))
    return rows.select("ItemID", "AttributeID", "ReferenceID", "TargetID", "Label")


@query(
    "item_subtables",
    """
SELECT s.ItemID, s.AttributeID, s.ItemTableID, s.Value FROM {fx_subtables} s
JOIN {fx_customer_items} i ON i.ID = s.ItemID AND i.LanguageID = s.LanguageID
WHERE EXISTS (SELECT 1 FROM {fx_class_attributes} c WHERE c.ClassID = CAST(trim(i.ClassMapping) AS BIGINT)
 AND c.AttributeID = s.AttributeID)""",
)
def item_subtables(fx: Fixtures) -> DataFrame:
    assigned = catalog.assigned_of_kind(
        fx.customer_items, fx.class_attributes, fx.class_kinds, fixed.KIND_SUBTABLE
    )
    rows = assemble.children_of_items(fx.customer_items, fx.subtables, cut_lineage(assigned))
    return rows.select("ItemID", "AttributeID", "ItemTableID", "Value")


def nested_rows(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    """Nested-table rows and their references with message fields."""
    fx = fx.stored()
    rows = fx.subtables.withColumn("fields", F.create_map(F.lit("191:Value"), "Value"))
    refs = fx.row_references.withColumn("fields", F.create_map(F.lit("TargetID"), text("TargetID")))
    return rows, refs


# Children of a nested row are cut into parts of this weight here, small enough for parts above 0 to be compared.
NESTED_LIMIT = 4


def nested_text(rows: Column, kind, attributes: list[str]) -> Column:
    """Rows of the first attribute as ``id:value``, each with those below it in brackets."""
    below = [f.name for f in kind.elementType.fields]

    def one(r: Column) -> Column:
        own = F.concat(text(r["ItemTableID"]), F.lit(":"), r["fields"]["191:Value"])
        if len(attributes) == 1 or "Subtable" not in below:
            return own
        inner = r["Subtable"][attributes[1]]
        deeper = nested_text(inner, kind.elementType["Subtable"].dataType.valueType, attributes[1:])
        return F.concat(own, F.when(inner.isNotNull(), F.concat(F.lit("["), deeper, F.lit("]"))).otherwise(F.lit("")))

    return listed(rows, one)


@query(
    "item_subtables_nested",
    f"""
WITH deep AS (SELECT s2.ItemID, s2._SubitemID, s2.SortOrder, s2.ItemTableID,
  1 + CASE WHEN s3.ItemID IS NULL THEN 0 ELSE 1 END + CASE WHEN s4.ItemID IS NULL THEN 0 ELSE 1 END AS w,
  concat(s2.ItemTableID, ':', s2.Value, CASE WHEN s3.ItemID IS NULL THEN '' ELSE concat('[', s3.ItemTableID, ':', s3.Value,
   CASE WHEN s4.ItemID IS NULL THEN '' ELSE concat('[', s4.ItemTableID, ':', s4.Value, ']') END, ']') END) AS txt
  FROM {{fx_subtables}} s2
  LEFT JOIN {{fx_subtables}} s3 ON s3._SubitemID = s2.ItemTableID AND s3.ItemID = s2.ItemID AND s3.AttributeID = 193
  LEFT JOIN {{fx_subtables}} s4 ON s4._SubitemID = s3.ItemTableID AND s4.ItemID = s3.ItemID AND s4.AttributeID = 194
  WHERE s2.AttributeID = 192),
 np AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY ItemID, _SubitemID ORDER BY SortOrder, ItemTableID
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {NESTED_LIMIT} AS part FROM deep),
 n AS (SELECT ItemID, _SubitemID, part, string_agg(txt, ',' ORDER BY SortOrder, ItemTableID) AS nested FROM np
  GROUP BY 1, 2, 3),
 rp AS (SELECT *, (row_number() OVER (PARTITION BY ItemID, _SubitemID ORDER BY AttributeID, SortOrder, ReferenceID) - 1)
  // {NESTED_LIMIT} AS part FROM {{fx_row_references}}),
 r AS (SELECT ItemID, _SubitemID, part, count(*) AS n_refs,
  string_agg(concat(AttributeID, '/', ReferenceID, '>', TargetID), ',' ORDER BY AttributeID, SortOrder, ReferenceID) AS refs
  FROM rp GROUP BY 1, 2, 3),
 parts AS (SELECT ItemID, _SubitemID, part FROM n UNION SELECT ItemID, _SubitemID, part FROM r)
SELECT s.ItemID, s.ItemTableID, CAST(coalesce(p.part, 0) AS INTEGER) AS part, s.Value, coalesce(n.nested, '') AS nested,
 coalesce(r.refs, '') AS refs, coalesce(r.n_refs, 0) AS n_refs FROM {{fx_subtables}} s
LEFT JOIN parts p ON p.ItemID = s.ItemID AND p._SubitemID = s.ItemTableID
LEFT JOIN n ON n.ItemID = s.ItemID AND n._SubitemID = s.ItemTableID AND n.part = p.part
LEFT JOIN r ON r.ItemID = s.ItemID AND r._SubitemID = s.ItemTableID AND r.part = p.part WHERE s._SubitemID = s.ItemID""",
)
def item_subtables_nested(fx: Fixtures) -> DataFrame:
    top = assemble.with_nested_rows(*nested_rows(fx), limit=NESTED_LIMIT)
    nested = nested_text(F.col("Subtable")["192"], top.schema["Subtable"].dataType.valueType, ["192", "193", "194"])
    return top.select(
        "ItemID",
        "ItemTableID",
        "part",
        F.col("fields")["191:Value"].alias("Value"),
        F.coalesce(nested, F.lit("")).alias("nested"),
        all_references(F.col("Reference")).alias("refs"),
        F.size(F.flatten(F.coalesce(F.map_values("Reference"), F.array()))).cast("bigint").alias("n_refs"),
    )


def all_references(references: Column) -> Column:
    """References of every attribute as ``attribute/id>target``, by attribute and in order."""
    entries = F.array_sort(F.map_entries(references), lambda x, y: x["key"].cast("int") - y["key"].cast("int"))
    texts = F.transform(
        entries,
        lambda e: listed(
            e["value"],
            lambda r: F.concat(e["key"], F.lit("/"), text(r["ReferenceID"]), F.lit(">"), r["fields"]["TargetID"]),
        ),
    )
    return F.coalesce(F.array_join(texts, ","), F.lit(""))


@query(
    "item_assembled",
    """
WITH i AS (SELECT ID, LanguageID, ID % 4 AS k, CAST(trim(ClassMapping) AS BIGINT) AS c1, 100 + ID % 6 AS c2
  FROM {fx_order_items}),
 special AS (SELECT ID FROM {fx_class_kinds} WHERE _TypeID IN (0, 2, 3)),
 given AS (SELECT DISTINCT i.ID, m.AttributeID FROM i JOIN {fx_class_attributes} m ON m.ClassID IN (i.c1, i.c2)
  UNION SELECT ID, -7 FROM i),
 plain AS (SELECT * FROM given WHERE AttributeID NOT IN (SELECT ID FROM special)),
 v AS (SELECT ID, string_agg(concat(AttributeID, '=v', ID % 10), ',' ORDER BY AttributeID) AS item_values FROM plain
  WHERE AttributeID IN (-7, 11, 13, 15, 19, 23) GROUP BY 1),
 r AS (SELECT r.ItemID, r.AttributeID, r.ReferenceID, r.SortOrder, r.TargetID, 100 + r.ReferenceID % 6 AS cls
  FROM {fx_references} r JOIN given g ON g.ID = r.ItemID AND g.AttributeID = r.AttributeID),
 rv AS (SELECT r.ItemID, r.AttributeID, r.ReferenceID, r.SortOrder, r.TargetID,
  coalesce(string_agg(concat(m.AttributeID, '=t', r.TargetID), ';' ORDER BY m.AttributeID)
   FILTER (WHERE m.AttributeID IS NOT NULL), '') AS vals
  FROM r LEFT JOIN (SELECT * FROM {fx_class_attributes} WHERE AttributeID IN (11, 15, 23)
   AND AttributeID NOT IN (SELECT ID FROM special)) m ON m.ClassID = r.cls GROUP BY 1, 2, 3, 4, 5),
 rp AS (SELECT *, CAST((row_number() OVER (PARTITION BY ItemID ORDER BY AttributeID, SortOrder, ReferenceID) - 1) // 2
  AS INTEGER) AS part FROM rv),
 refs AS (SELECT ItemID, part, string_agg(concat(AttributeID, '/', ReferenceID, '>', TargetID, '{', vals, '}'), ','
  ORDER BY AttributeID, SortOrder, ReferenceID) AS refs FROM rp GROUP BY 1, 2)
SELECT i.ID, coalesce(p.part, 0) AS part, CASE WHEN coalesce(p.part, 0) = 0 THEN coalesce(v.item_values, '') ELSE '' END
 AS item_values, coalesce(p.refs, '') AS refs FROM i LEFT JOIN v ON v.ID = i.ID LEFT JOIN refs p ON p.ItemID = i.ID""",
)
def item_assembled(fx: Fixtures) -> DataFrame:
    ident = F.col("ID")

    def values(ids: tuple[int, ...], value: Column) -> Column:
        pair = F.struct(value.alias("value"), value.alias("formatted"))
        return F.create_map(*[x for i in ids for x in (F.lit(i).cast("bigint"), pair)])

    items = fx.order_items.select(
        "ID", "LanguageID", F.lit("Order").alias("item_type"),
        F.concat("ClassMapping", F.lit(" "), text(100 + ident % 6), F.lit(" ")).alias("ClassMapping"),
        values((-7, 11, 13, 15, 19, 23, 77), F.concat(F.lit("v"), text(ident % 10))).alias("attrs"),
    )
    references = fx.references.withColumns(
        {
            "ClassID": 100 + F.col("ReferenceID") % 6,
            "ExternalKey": F.concat(F.lit("R"), text("SortOrder")),
            "attrs": values((11, 15, 23, 77), F.concat(F.lit("t"), text("TargetID"))),
        }
    )
    tables = fx.subtables.withColumns(
        {"ClassID": F.lit(0).cast("bigint"), "ExternalKey": F.lit(""), "attrs": values((11,), F.col("Value"))}
    )
    found = assemble.assembled_items(
        items, fx.class_attributes, fx.class_kinds, references, tables, plugin_ids=[-7], limit=2
    )

    def by_number(m: Column) -> Column:
        return F.array_sort(F.map_entries(m), lambda x, y: (x["key"].cast("bigint") - y["key"].cast("bigint")).cast("int"))

    def pairs(m: Column, separator: str) -> Column:
        shown = F.transform(by_number(m), lambda e: F.concat(text(e["key"]), F.lit("="), e["value"]["value"]))
        return F.array_join(shown, separator)

    refs = F.transform(
        by_number(F.col("Reference")),
        lambda e: listed(
            e["value"],
            lambda r: F.concat(
                e["key"], F.lit("/"), text(r["ReferenceID"]), F.lit(">"), text(r["TargetID"]), F.lit("{"),
                pairs(r["attrs"], ";"), F.lit("}"),
            ),
        ),
    )
    return found.select(
        "ID", "part", pairs(F.col("attrs"), ",").alias("item_values"), F.coalesce(F.array_join(refs, ","), F.lit("")).alias("refs")
    )


# Customers share a few class lists; the attributes these and the rows' own classes assign decide what is shown.
NESTED_CLASSES = """customers AS (SELECT c_custkey AS ID, 100 + c_custkey % 5 AS c1, 200 + c_custkey % 7 AS c2 FROM customer),
 mapping AS (SELECT ClassID, AttributeID FROM {fx_class_attributes} UNION SELECT 100, 191),
 special AS (SELECT ID FROM {fx_class_kinds} WHERE _TypeID IN (0, 2, 3)),
 owners AS (SELECT ID FROM customers WHERE c1 = 100),
 own AS (SELECT ItemTableID, coalesce(string_agg(concat(m.AttributeID, '=', Value), ';' ORDER BY m.AttributeID)
   FILTER (WHERE m.AttributeID IS NOT NULL), '') AS vals
  FROM (SELECT *, 100 + ItemTableID % 6 AS cls FROM {fx_subtables}) s LEFT JOIN (SELECT * FROM mapping WHERE AttributeID IN
   (11, 15, 23) AND AttributeID NOT IN (SELECT ID FROM special)) m ON m.ClassID = s.cls GROUP BY 1),
 refs AS (SELECT _SubitemID, string_agg(concat(AttributeID, '/', ReferenceID, '>', TargetID, '{', vals, '}'), ','
   ORDER BY AttributeID, SortOrder, ReferenceID) AS refs FROM (
  SELECT r._SubitemID, r.AttributeID, r.ReferenceID, r.SortOrder, r.TargetID, coalesce(string_agg(concat(m.AttributeID, '=t',
   r.TargetID), ';' ORDER BY m.AttributeID) FILTER (WHERE m.AttributeID IS NOT NULL), '') AS vals
  FROM (SELECT *, 100 + ReferenceID % 6 AS cls FROM {fx_row_references}) r LEFT JOIN (SELECT * FROM mapping WHERE AttributeID IN
   (11, 15, 23) AND AttributeID NOT IN (SELECT ID FROM special)) m ON m.ClassID = r.cls GROUP BY ALL) GROUP BY 1)"""


def assembled_customers(fx: Fixtures) -> DataFrame:
    """Customers assembled with their order rows, what hangs below these to four levels, and the references of rows."""
    fx = fx.stored()
    key = F.col("c_custkey")

    def values(ids: tuple[int, ...], value: Column) -> Column:
        pair = F.struct(value.alias("value"), value.alias("formatted"))
        return F.create_map(*[x for i in ids for x in (F.lit(i).cast("bigint"), pair)])

    items = fx.table("customer").select(
        key.alias("ID"), F.lit(2).cast("bigint").alias("LanguageID"), F.lit("Customer").alias("item_type"),
        F.format_string(" %d %d ", 100 + key % 5, 200 + key % 7).alias("ClassMapping"), values((11,), F.lit("v")).alias("attrs"),
    )
    rows = fx.subtables.withColumns(
        {"ClassID": 100 + F.col("ItemTableID") % 6, "ExternalKey": F.concat(F.lit("K"), text(F.col("ItemTableID") % 3)),
         "attrs": values((11, 15, 23, 77), F.col("Value"))}
    )
    references = fx.row_references.withColumns(
        {"ClassID": 100 + F.col("ReferenceID") % 6, "ExternalKey": F.lit(""),
         "attrs": values((11, 15, 23, 77), F.concat(F.lit("t"), text("TargetID")))}
    )
    order_rows = fx.spark.range(1).select(F.lit(100).cast("bigint").alias("ClassID"), F.lit(191).cast("bigint").alias("AttributeID"))
    mapping = fx.class_attributes.select("ClassID", "AttributeID").unionByName(order_rows)
    return assemble.assembled_items(items, mapping, fx.class_kinds, references, rows)


@query(
    "item_nested",
    "WITH " + NESTED_CLASSES + """
SELECT ItemID AS ID, AttributeID - 190 AS level, s.ItemTableID, s._SubitemID AS below, o.vals, coalesce(r.refs, '') AS refs
FROM {fx_subtables} s JOIN own o ON o.ItemTableID = s.ItemTableID LEFT JOIN refs r ON r._SubitemID = s.ItemTableID
WHERE ItemID IN (SELECT ID FROM owners)""",
)
def item_nested(fx: Fixtures) -> DataFrame:
    found = assembled_customers(fx)

    def by_number(m: Column) -> Column:
        return F.array_sort(F.map_entries(m), lambda x, y: (x["key"].cast("bigint") - y["key"].cast("bigint")).cast("int"))

    def pairs(m: Column) -> Column:
        return F.array_join(F.transform(by_number(m), lambda e: F.concat(text(e["key"]), F.lit("="), e["value"]["value"])), ";")

    def references(m: Column) -> Column:
        def one(e: Column) -> Column:
            return listed(e["value"], lambda r: F.concat(
                e["key"], F.lit("/"), text(r["ReferenceID"]), F.lit(">"), text(r["TargetID"]), F.lit("{"), pairs(r["attrs"]), F.lit("}")
            ))

        return F.coalesce(F.array_join(F.transform(by_number(m), one), ","), F.lit(""))

    def unfolded(r: Column, kind, below: Column, number: int) -> Column:
        """A row with the id of what it hangs below, and the rows below it in turn."""
        own = F.array(F.struct(
            F.lit(number).cast("bigint").alias("level"), r["ItemTableID"].alias("ItemTableID"), below.cast("bigint").alias("below"),
            pairs(r["attrs"]).alias("vals"), references(r["Reference"]).alias("refs"),
        ))
        if number == 4 or "Subtable" not in kind.fieldNames():
            return own
        inner = F.flatten(F.coalesce(F.map_values(r["Subtable"]), F.array()))
        deeper = kind["Subtable"].dataType.valueType.elementType
        return F.concat(own, F.flatten(F.transform(inner, lambda c: unfolded(c, deeper, r["ItemTableID"], number + 1))))

    # The items are assembled once and every row is unfolded where it lies.
    kind = found.schema["Subtable"].dataType.valueType.elementType
    tops = found.select("ID", F.explode(F.flatten(F.map_values("Subtable"))).alias("r"))
    return tops.select("ID", F.inline(unfolded(F.col("r"), kind, F.col("ID"), 1)))


@query(
    "held_values",
    "WITH " + NESTED_CLASSES + """,
 named AS (SELECT s.ItemID, s.ItemTableID, s.Value, s.SortOrder, 100 + s.ItemTableID % 6 AS cls, s.ItemTableID % 3 AS k
  FROM {fx_subtables} s WHERE AttributeID = 191 AND ItemID IN (SELECT ID FROM owners)),
 held AS (SELECT n.*, a.id AS a, CASE WHEN EXISTS (SELECT 1 FROM mapping m WHERE m.ClassID = n.cls AND m.AttributeID = a.id
   AND m.AttributeID NOT IN (SELECT ID FROM special)) THEN Value ELSE '-' END AS v FROM named n, (SELECT unnest([11, 15]) AS id) a)
SELECT ItemID AS ID, string_agg(v, ',' ORDER BY SortOrder, ItemTableID) FILTER (WHERE a = 11) AS by_id,
 string_agg(v, ',' ORDER BY SortOrder, ItemTableID) FILTER (WHERE a = 15) AS by_attribute_key,
 coalesce(string_agg(v, ',' ORDER BY SortOrder, ItemTableID) FILTER (WHERE a = 11 AND k = 1), '') AS of_row_key
FROM held GROUP BY 1""",
)
def held_values(fx: Fixtures) -> DataFrame:
    rows = F.col("Subtable")["191"]
    keys = F.create_map(F.lit("N-1"), F.lit(11).cast("bigint"), F.lit("N-5"), F.lit(15).cast("bigint"))

    def shown(values: Column) -> Column:
        return F.array_join(values, ",", "-")

    return assembled_customers(fx).where(rows.isNotNull()).select(
        "ID", shown(assemble.held_value(rows, F.lit(11).cast("bigint"))).alias("by_id"),
        shown(assemble.held_value_by_key(rows, "N-5", keys)).alias("by_attribute_key"),
        shown(assemble.held_value(assemble.rows_of_external_key(rows, "K1"), F.lit(11).cast("bigint"))).alias("of_row_key"),
    )


@query(
    "view_extension",
    """
SELECT i.ID AS ItemID, s.ItemTableID, s.Value, 'view' AS origin FROM {fx_customer_items} i
JOIN {fx_subtables} s ON s.ItemID = i.ID AND s.LanguageID = i.LanguageID
UNION ALL SELECT i.ID, s.ItemTableID, s.Value, 'base' FROM {fx_customer_items} i
JOIN {fx_subtables} s ON s.ItemID = i._ExtensionID AND s.LanguageID = i.LanguageID""",
)
def view_extension(fx: Fixtures) -> DataFrame:
    return assemble.with_base_rows(fx.customer_items, fx.subtables, fx.subtables).select("ItemID", "ItemTableID", "Value", "origin")


@query(
    "group_references",
    """
WITH p AS (SELECT *, CAST((row_number() OVER (PARTITION BY ItemID, LanguageID, AttributeID
  ORDER BY SortOrder, ReferenceID) - 1) // 2 AS INTEGER) AS part FROM {fx_references})
SELECT ItemID, LanguageID, AttributeID, part, count(*) AS n,
 string_agg(concat(SortOrder, ':', TargetID), ',' ORDER BY SortOrder, ReferenceID) AS refs
FROM p GROUP BY 1, 2, 3, 4""",
)
def group_references(fx: Fixtures) -> DataFrame:
    grouped = language.group_rows(
        fx.references, F.struct("SortOrder", "ReferenceID", "TargetID"), ["SortOrder", "ReferenceID"], limit=2
    )
    return grouped.select(
        "ItemID", "LanguageID", "AttributeID", "part", F.size("rows").cast("bigint").alias("n"),
        listed(F.col("rows"), lambda r: F.concat(text(r["SortOrder"]), F.lit(":"), text(r["TargetID"]))).alias("refs"),
    )


@query(
    "group_subtables",
    """
WITH p AS (SELECT *, CAST((row_number() OVER (PARTITION BY ItemID, LanguageID, AttributeID
  ORDER BY SortOrder, ItemTableID) - 1) // 5 AS INTEGER) AS part FROM {fx_subtables})
SELECT ItemID, LanguageID, AttributeID, part, count(*) AS n,
 string_agg(concat(ItemTableID, ':', Value), ',' ORDER BY SortOrder, ItemTableID) AS table_rows
FROM p GROUP BY 1, 2, 3, 4""",
)
def group_subtables(fx: Fixtures) -> DataFrame:
    item = F.struct("SortOrder", "ItemTableID", "Value")
    grouped = language.group_rows(fx.subtables, item, ["SortOrder", "ItemTableID"], limit=5)
    return grouped.select(
        "ItemID", "LanguageID", "AttributeID", "part", F.size("rows").cast("bigint").alias("n"),
        listed(F.col("rows"), lambda r: F.concat(text(r["ItemTableID"]), F.lit(":"), r["Value"])).alias("table_rows"),
    )


@query(
    "rows_by_attribute",
    """
WITH p AS (SELECT *, CAST((row_number() OVER (PARTITION BY ItemID ORDER BY SortOrder, ReferenceID) - 1) // 3
  AS INTEGER) AS part FROM {fx_references})
SELECT ItemID, part, count(*) FILTER (WHERE AttributeID = 31) AS n_by_id,
 coalesce(string_agg(CAST(TargetID AS VARCHAR), ',' ORDER BY SortOrder, ReferenceID)
  FILTER (WHERE AttributeID = 31), '') AS by_id,
 coalesce(string_agg(CAST(TargetID AS VARCHAR), ',' ORDER BY SortOrder, ReferenceID)
  FILTER (WHERE SortOrder = 2), '') AS by_key,
 coalesce(string_agg(CAST(TargetID AS VARCHAR), ',' ORDER BY SortOrder, ReferenceID)
  FILTER (WHERE AttributeID = 32), '') AS by_attribute_key
FROM p GROUP BY 1, 2""",
)
def rows_by_attribute(fx: Fixtures) -> DataFrame:
    from tidemark.operators.gather import gather

    keyed = fx.references.withColumn("ExternalKey", F.concat(F.lit("R"), text("SortOrder")))
    item = F.struct("SortOrder", "ReferenceID", "AttributeID", "ExternalKey", "TargetID")
    assembled = gather(keyed, ["ItemID"], item, ["SortOrder", "ReferenceID"], limit=3)
    # The attribute's external key resolves to its id through the key table: N-2 is attribute 30 + 2.
    named = fx.table("nation").select(
        (30 + F.col("n_nationkey")).alias("ID"), F.concat(F.lit("N-"), text("n_nationkey")).alias("ExternalKey")
    )
    key_id = catalog.ids_by_external_key(named).where(F.col("ExternalKey") == "N-2").select("AttributeID").scalar()

    def targets(rows: Column) -> Column:
        return listed(rows, lambda r: text(r["TargetID"]))

    by_id = assemble.rows_of_attribute(F.col("rows"), 31)
    return assembled.withColumn("key_id", key_id).select(
        "ItemID",
        "part",
        F.size(by_id).cast("bigint").alias("n_by_id"),
        targets(by_id).alias("by_id"),
        targets(assemble.rows_of_external_key(F.col("rows"), "R2")).alias("by_key"),
        targets(assemble.rows_of_attribute(F.col("rows"), F.col("key_id"))).alias("by_attribute_key"),
    )


@query(
    "replace_children",
    """
WITH changed AS (SELECT o_orderkey AS ItemID FROM orders WHERE o_orderstatus = 'P'),
 children AS (SELECT CASE WHEN AttributeID = 31 THEN 'Quote' ELSE SourceType END AS SourceType, ItemID, AttributeID,
  ReferenceID, TargetID, SortOrder FROM {fx_references})
SELECT SourceType, ItemID, AttributeID, ReferenceID, TargetID FROM children
WHERE SourceType <> 'Order' OR ItemID NOT IN (SELECT ItemID FROM changed)
UNION ALL SELECT SourceType, ItemID, AttributeID + 1, ReferenceID, TargetID + 1 FROM children
WHERE SourceType = 'Order' AND ItemID IN (SELECT ItemID FROM changed) AND SortOrder % 2 = 1""",
)
def replace_children(fx: Fixtures) -> DataFrame:
    changed = fx.table("orders").where(F.col("o_orderstatus") == "P").select(
        F.lit("Order").alias("SourceType"), F.col("o_orderkey").alias("ItemID")
    )
    # Orders and quotes share their ids.
    own = F.when(F.col("AttributeID") == 31, "Quote").otherwise(F.col("SourceType"))
    children = fx.references.withColumn("SourceType", own)
    rows = children.select("SourceType", "ItemID", "AttributeID", "ReferenceID", "TargetID")
    new = children.where(F.col("SortOrder") % 2 == 1).select(
        "SourceType", "ItemID", (F.col("AttributeID") + 1).alias("AttributeID"), "ReferenceID", (F.col("TargetID") + 1).alias("TargetID")
    )
    return apply.replace_children(rows, changed, new)


@query(
    "apply_delete",
    """
WITH d AS (SELECT DISTINCT CASE ID % 3 WHEN 0 THEN 'Part' WHEN 1 THEN 'Order' ELSE 'Customer' END AS item_type,
  unnest(CASE WHEN event_id % 100 = 0 THEN [ID, ID + 7] ELSE [ID] END) AS ID FROM {fx_changes} WHERE Action = 2)
SELECT 'item' AS kind, ID, count(*) AS n FROM {fx_items} i
WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.item_type = 'Part' AND d.ID = i.ID) GROUP BY 2
UNION ALL SELECT 'reference', ItemID, count(*) FROM {fx_references} r
WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.item_type = r.SourceType AND d.ID = r.ItemID) GROUP BY 2
UNION ALL SELECT 'subtable', ItemID, count(*) FROM {fx_subtables} s
WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.item_type = s.ItemType AND d.ID = s.ItemID) GROUP BY 2""",
)
def apply_delete(fx: Fixtures) -> DataFrame:
    ident = F.col("ID")
    message = F.when(F.col("event_id") % 100 == 0, F.format_string("%d, %d", ident, ident + 7)).otherwise(F.lit(""))
    deleted = (
        fx.changes.where(F.col("Action") == fixed.ACTION_DELETE)
        .select(
            F.when(ident % 3 == 0, "Part").when(ident % 3 == 1, "Order").otherwise("Customer").alias("item_type"),
            F.explode(read_delete("ID", message)["ids"]).alias("ID"),
        )
    )
    parts = fx.items.select(F.lit("Part").alias("item_type"), "ID")
    items, references, subtables = apply.delete_items(parts, fx.references, fx.subtables, deleted)

    def counted(df: DataFrame, kind: str, key: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("ID")).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(kind).alias("kind"), "ID", "n"
        )

    return (
        counted(items, "item", "ID")
        .unionByName(counted(references, "reference", "ItemID"))
        .unionByName(counted(subtables, "subtable", "ItemID"))
    )


@query(
    "record_replace",
    """
WITH base AS (SELECT c_custkey AS ID, CAST(0 AS BIGINT) AS StateID, c_name AS Label FROM customer),
 inc AS (SELECT DISTINCT o_custkey AS ID FROM orders WHERE o_orderstatus = 'P'),
 states AS (SELECT DISTINCT o_custkey AS ID, o_orderkey % 8 + 1 AS StateID FROM orders WHERE o_orderstatus = 'P')
SELECT * FROM base WHERE ID NOT IN (SELECT ID FROM inc)
UNION ALL SELECT ID, 0, 'replaced' FROM inc
UNION ALL SELECT ID, StateID, concat('s', CAST(StateID AS VARCHAR)) FROM states""",
)
def record_replace(fx: Fixtures) -> DataFrame:
    records = fx.table("customer").select(
        F.col("c_custkey").alias("ID"), F.lit(0).cast("bigint").alias("StateID"), F.col("c_name").alias("Label")
    )
    state = F.col("o_orderkey") % 8 + 1
    # At most eight states per workflow, so the set is bounded.
    incoming = (
        fx.table("orders").where(F.col("o_orderstatus") == "P")
        .groupBy(F.col("o_custkey").alias("ID"))
        .agg(F.collect_set(F.struct(state.alias("StateID"), F.concat(F.lit("s"), text(state)).alias("Label"))).alias("states"))
        .select("ID", F.lit(0).cast("bigint").alias("StateID"), F.lit("replaced").alias("Label"), "states")
    )
    return apply.replace_records(records, incoming)


@query(
    "cascade_workflow",
    """
WITH t AS (SELECT ID, LanguageID, CASE WHEN ID % 5 = 0 THEN 'Mamfile' ELSE 'Pdmarticle' END AS item_type, WorkflowID, StateID
  FROM {fx_items}),
 hit AS (SELECT *, EXISTS (SELECT 1 FROM {fx_deleted} d WHERE d.item_type = t.item_type AND field = 'WorkflowID'
   AND value = WorkflowID) AS w, EXISTS (SELECT 1 FROM {fx_deleted} d WHERE d.item_type = t.item_type AND field = 'StateID'
   AND value = StateID) AS s FROM t)
SELECT ID, LanguageID, item_type, CASE WHEN w OR s THEN 0 ELSE WorkflowID END AS WorkflowID,
 CASE WHEN w OR s THEN 0 ELSE StateID END AS StateID, CASE WHEN s THEN 1 ELSE 0 END AS by_state,
 CASE WHEN w OR s THEN '0/0/kept' ELSE concat(WorkflowID, '/', StateID, '/kept') END AS document FROM hit""",
)
def cascade_workflow(fx: Fixtures) -> DataFrame:
    kind = F.when(F.col("ID") % 5 == 0, "Mamfile").otherwise("Pdmarticle")
    items = fx.items.select("ID", "LanguageID", kind.alias("item_type"), "WorkflowID", "StateID")
    cleared = cascade.clear_workflows(items, fx.deleted, keep_flags=True)
    documents = items.select(
        "ID", "LanguageID", "item_type",
        F.create_map(
            F.lit("WorkflowID"), text("WorkflowID"), F.lit("StateID"), text("StateID"), F.lit("Label"), F.lit("kept")
        ).alias("fields"),
    )
    fields = F.col("fields")
    shown = cascade.clear_document_workflows(documents, fx.deleted).select(
        "ID", "LanguageID", F.concat_ws("/", fields["WorkflowID"], fields["StateID"], fields["Label"]).alias("document")
    )
    return cleared.join(shown, ["ID", "LanguageID"]).select(
        "ID", "LanguageID", "item_type", "WorkflowID", "StateID", F.col("deleted_StateID").cast("int").alias("by_state"),
        "document",
    )


@query(
    "cascade_language",
    """
SELECT ID, LanguageID, Label FROM {fx_items} WHERE LanguageID NOT IN (
 SELECT 1 + ID % 2 * 2 FROM {fx_changes} WHERE Action = 2 AND ID % 2 = 1)""",
)
def cascade_language(fx: Fixtures) -> DataFrame:
    gone = fx.changes.where((F.col("Action") == fixed.ACTION_DELETE) & (F.col("ID") % 2 == 1)).select(
        (1 + F.col("ID") % 2 * 2).alias("LanguageID")
    )
    return cascade.drop_languages(fx.items, gone).select("ID", "LanguageID", "Label")


@query(
    "type_set_change",
    """
WITH removed AS (SELECT DISTINCT item_type FROM {fx_changes} WHERE Action = 2 AND ID % 4 = 1),
 types AS (SELECT event_id AS ID, item_type FROM {fx_changes}
  UNION ALL SELECT o_orderkey, 'Order' FROM orders)
SELECT item_type, count(*) AS n, CAST(sum(ID) AS BIGINT) AS id_sum FROM types
WHERE item_type NOT IN (SELECT item_type FROM removed) GROUP BY 1""",
)
def type_set_change(fx: Fixtures) -> DataFrame:
    rows = fx.changes.select(F.col("event_id").alias("ID"), "item_type")
    added = fx.table("orders").select(F.col("o_orderkey").alias("ID"), F.lit("Order").alias("item_type"))
    message = F.concat(F.lit('{"Item":"'), F.col("item_type"), F.lit('"}'))
    removed = fx.changes.where((F.col("Action") == fixed.ACTION_DELETE) & (F.col("ID") % 4 == 1)).select(
        F.explode(comma_list(F.get_json_object(message, "$.Item"))).alias("item_type")
    )
    return cascade.change_types(rows, added, removed).groupBy("item_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ID").alias("id_sum")
    )
