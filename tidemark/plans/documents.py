"""Search documents: built, routed, split, re-projected and deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.maps import keep_keys, keep_paths, without_attributes, without_nulls
from tidemark.operators import documents as docs_ops
from tidemark.operators import notices
from tidemark.plans.assembly import all_references, nested_rows, nested_text
from tidemark.plans.fixtures import Fixtures, text
from tidemark.plans.registry import query
from tidemark.session import shared_dir
from tidemark.sources.sinks import read_documents, route_documents, write_documents

# Long form of the message fields every item carries, for the SQL side.
FIELDS_SQL = """
SELECT ID, LanguageID, unnest(['ID', 'LanguageID', 'Label', 'ClassMapping', 'StateID', 'WorkflowID', 'ExternalKey',
  '_Parents', 'CheckoutUser']) AS name,
 unnest([CAST(ID AS VARCHAR), CAST(LanguageID AS VARCHAR), Label, ClassMapping, CAST(StateID AS VARCHAR),
  CAST(WorkflowID AS VARCHAR), ExternalKey, _Parents, CASE WHEN CheckoutUser > 0 THEN CAST(CheckoutUser AS VARCHAR) END])
  AS value FROM {fx_items}
UNION ALL SELECT ID, LanguageID, concat(AttributeID, ':Value'), Value FROM {fx_item_values}
UNION ALL SELECT ID, LanguageID, concat(AttributeID, ':FormattedValue'), FormattedValue FROM {fx_item_values}"""


def long_form(df: DataFrame, column: str = "fields") -> DataFrame:
    return df.select("ID", "LanguageID", F.explode(column).alias("name", "value"))


@query(
    "null_strip",
    f"WITH f AS ({FIELDS_SQL}) SELECT ID, LanguageID, count(*) AS n_fields, count(*) FILTER (WHERE name = 'CheckoutUser') "
    "AS checked_out FROM f WHERE value IS NOT NULL GROUP BY 1, 2",
)
def null_strip(fx: Fixtures) -> DataFrame:
    kept = without_nulls("fields")
    return fx.item_fields.select(
        "ID", "LanguageID", F.size(kept).cast("bigint").alias("n_fields"),
        F.map_contains_key(kept, F.lit("CheckoutUser")).cast("bigint").alias("checked_out"),
    )


@query(
    "drop_dynamic_attrs",
    f"WITH f AS ({FIELDS_SQL}) SELECT ID, LanguageID, name, value FROM f "
    "WHERE split_part(name, ':', 1) NOT IN ('43', '44')",
)
def drop_dynamic_attrs(fx: Fixtures) -> DataFrame:
    return long_form(fx.item_fields.withColumn("fields", without_attributes("fields", [43, 44])))


@query(
    "searchable_projection",
    f"WITH f AS ({FIELDS_SQL}) SELECT ID, LanguageID, name, value FROM f "
    "WHERE name IN ('Label', '13:Value', concat(CAST(42 + ID % 3 AS VARCHAR), ':Value'))",
)
def searchable_projection(fx: Fixtures) -> DataFrame:
    searchable = F.array(F.lit("Label"), F.lit("13:Value"), F.concat(text(42 + F.col("ID") % 3), F.lit(":Value")))
    return long_form(fx.item_fields.withColumn("fields", keep_keys("fields", searchable)))


@query(
    "notify_payload",
    f"WITH f AS ({FIELDS_SQL}) SELECT ID, LanguageID, CASE WHEN regexp_matches(name, '^-?[0-9]+:(Formatted)?Value$') OR "
    "name IN ('Label', 'WorkflowID', 'StateID') THEN 'language' ELSE 'root' END AS place, name, CASE name WHEN "
    "'ClassMapping' THEN replace(trim(value), ' ', ',') ELSE value END AS value FROM f WHERE left(name, 1) <> '_'",
)
def notify_payload(fx: Fixtures) -> DataFrame:
    sent = notices.payloads(fx.item_fields.withColumn("Action", F.lit(fixed.ACTION_UPDATE)))
    classes = F.create_map(F.lit("ClassMapping"), F.array_join("classes", ","))

    def placed(m: Column, place: str) -> Column:
        shown = F.transform(F.map_entries(m), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value"), F.lit(place).alias("place")))
        return F.coalesce(shown, F.array())

    # A payload is built once and shown whole.
    parts = [placed(F.col("language_fields"), "language"), placed(F.col("root_fields"), "root"), placed(classes, "root")]
    return sent.select("ID", "LanguageID", F.inline(F.concat(*parts)))


def customer_documents(fx: Fixtures, affected: DataFrame | None = None) -> DataFrame:
    """Customers with their orders and order lines inside."""
    items = fx.customer_items.select(
        "ID", "LanguageID",
        F.create_map(F.lit("Label"), "Label", F.lit("Note"), F.concat(F.lit("<b>"), "Segment", F.lit("</b> &amp; co"))
                     , F.lit("None"), F.lit(None).cast("string")).alias("fields"),
    )
    rows, refs = nested_rows(fx)
    own = refs.withColumn("_SubitemID", F.col("ItemID"))
    return docs_ops.build_documents(items, refs.unionByName(own), rows, html_fields=["Note"], affected=affected)


def size_of(m: Column) -> Column:
    return F.coalesce(F.size(m), F.lit(0)).cast("bigint")


@query(
    "doc_build",
    """
WITH deep AS (SELECT s2.ItemID, s2._SubitemID, s2.SortOrder, s2.ItemTableID,
  concat(s2.ItemTableID, ':', s2.Value, CASE WHEN s3.ItemID IS NULL THEN '' ELSE concat('[', s3.ItemTableID, ':', s3.Value,
   CASE WHEN s4.ItemID IS NULL THEN '' ELSE concat('[', s4.ItemTableID, ':', s4.Value, ']') END, ']') END) AS txt
  FROM {fx_subtables} s2
  LEFT JOIN {fx_subtables} s3 ON s3._SubitemID = s2.ItemTableID AND s3.ItemID = s2.ItemID AND s3.AttributeID = 193
  LEFT JOIN {fx_subtables} s4 ON s4._SubitemID = s3.ItemTableID AND s4.ItemID = s3.ItemID AND s4.AttributeID = 194
  WHERE s2.AttributeID = 192),
 below AS (SELECT ItemID, _SubitemID, count(*) AS n, string_agg(txt, ',' ORDER BY SortOrder, ItemTableID) AS txt FROM deep
  GROUP BY 1, 2),
 t AS (SELECT s.ItemID, count(*) AS n_rows, string_agg(concat(s.ItemTableID, ':', s.Value,
   CASE WHEN b.txt IS NULL THEN '' ELSE concat('[', b.txt, ']') END), ',' ORDER BY s.ItemTableID) AS table_rows
  FROM {fx_subtables} s LEFT JOIN below b ON b.ItemID = s.ItemID AND b._SubitemID = s.ItemTableID
  WHERE s.AttributeID = 191 GROUP BY 1),
 n AS (SELECT ItemID, count(*) AS n_nested FROM {fx_subtables} WHERE AttributeID = 192 GROUP BY 1),
 r AS (SELECT ItemID, count(*) AS n_refs, string_agg(concat(AttributeID, '/', ReferenceID, '>', TargetID), ','
  ORDER BY AttributeID, SortOrder, ReferenceID) AS refs FROM {fx_row_references} GROUP BY 1)
SELECT i.ID, i.LanguageID, 0 AS part, i.Label, concat(i.Segment, ' & co') AS note, CAST(2 AS BIGINT) AS n_fields,
 coalesce(t.n_rows, 0) AS n_rows, coalesce(t.table_rows, '') AS table_rows, coalesce(n.n_nested, 0) AS n_nested,
 coalesce(r.n_refs, 0) AS n_refs, coalesce(r.refs, '') AS refs
FROM {fx_customer_items} i LEFT JOIN t ON t.ItemID = i.ID LEFT JOIN n ON n.ItemID = i.ID LEFT JOIN r ON r.ItemID = i.ID""",
)
def doc_build(fx: Fixtures) -> DataFrame:
    docs = customer_documents(fx)
    rows = F.coalesce(F.col("Subtable")["191"], F.array())
    kind = docs.schema["Subtable"].dataType.valueType
    nested = F.aggregate(rows, F.lit(0).cast("bigint"), lambda acc, r: acc + size_of(r["Subtable"]["192"]))
    return docs.select(
        "ID", "LanguageID", "part",
        F.col("fields")["Label"].alias("Label"),
        F.col("fields")["Note"].alias("note"),
        F.size("fields").cast("bigint").alias("n_fields"),
        F.size(rows).cast("bigint").alias("n_rows"),
        nested_text(rows, kind, ["191", "192", "193", "194"]).alias("table_rows"),
        nested.alias("n_nested"),
        F.size(F.flatten(F.coalesce(F.map_values("Reference"), F.array()))).cast("bigint").alias("n_refs"),
        all_references(F.col("Reference")).alias("refs"),
    )


@query(
    "reindex_projection",
    """
WITH hit AS (SELECT DISTINCT ID FROM {fx_changes} WHERE event_type = 'view'),
 t AS (SELECT ItemID, count(*) AS n_rows FROM {fx_subtables} WHERE AttributeID = 191 GROUP BY 1)
, r AS (SELECT ItemID, count(*) AS n_refs FROM {fx_row_references} WHERE AttributeID = 31 GROUP BY 1)
SELECT i.ID, i.LanguageID, 'Label' AS fields, coalesce(t.n_rows, 0) AS n_rows, coalesce(r.n_refs, 0) AS n_refs,
 CASE WHEN r.n_refs IS NULL THEN 'Label' ELSE 'Label,Reference.31.1' END AS paths
FROM {fx_customer_items} i LEFT JOIN t ON t.ItemID = i.ID LEFT JOIN r ON r.ItemID = i.ID
WHERE i.ID IN (SELECT ID FROM hit)""",
)
def reindex_projection(fx: Fixtures) -> DataFrame:
    affected = fx.changes.where(F.col("event_type") == "view").select("ID")
    fields, refs, tables = docs_ops.reindex_fields(None, ["31"], ["191"], ["Label", "ID"])
    docs = customer_documents(fx, affected)
    found = docs_ops.reproject(docs, affected, fields, refs, tables, [2])
    # The document's own paths: its fields, and the first reference of each attribute.
    names = F.map_keys(F.coalesce("Reference", F.create_map().cast(docs.schema["Reference"].dataType)))
    flat = F.map_from_entries(
        F.concat(
            F.transform(F.map_keys("fields"), lambda k: F.struct(k.alias("k"), F.lit("x").alias("v"))),
            F.transform(names, lambda k: F.struct(F.concat(F.lit("Reference."), k, F.lit(".1")).alias("k"), F.lit("x").alias("v"))),
        )
    )
    return found.select(
        "ID", "LanguageID", F.array_join(F.map_keys("fields"), ",").alias("fields"),
        size_of(F.col("Subtable")["191"]).alias("n_rows"), size_of(F.col("Reference")["31"]).alias("n_refs"),
        F.array_join(F.sort_array(F.map_keys(keep_paths(flat, ["Label", "Reference.31.*"]))), ",").alias("paths"),
    )


@query(
    "doc_delete",
    """
SELECT i.ID, i.LanguageID FROM {fx_items} i WHERE i.ID NOT IN (
 SELECT CASE WHEN event_id % 100 = 0 THEN ID + 100000000 ELSE ID END FROM {fx_changes} WHERE Action = 2)""",
)
def doc_delete(fx: Fixtures) -> DataFrame:
    missing = F.when(F.col("event_id") % 100 == 0, F.col("ID") + 100000000).otherwise(F.col("ID"))
    deleted = fx.changes.where(F.col("Action") == fixed.ACTION_DELETE).select(missing.alias("ID"))
    return docs_ops.delete_documents(fx.items.select("ID", "LanguageID"), deleted)


@query(
    "doc_routing",
    """
WITH d AS (SELECT ID, LanguageID, CASE ID % 3 WHEN 0 THEN 'Pdmarticle' WHEN 1 THEN 'MamfileContent' ELSE 'User' END
 AS item_type FROM {fx_items})
SELECT ID, LanguageID, CASE WHEN item_type = 'MamfileContent' THEN 'export_mamfilecontent'
 ELSE concat('export_', lower(item_type), '_', LanguageID) END AS document_set,
 CASE WHEN item_type = 'MamfileContent' THEN '' ELSE concat('export_', lower(item_type), '_search_', LanguageID) END
 AS search_set, CAST(ID AS VARCHAR) AS document_id, concat('export_', lower(item_type)) AS common_set,
 concat(ID, '_', LanguageID) AS common_id FROM d""",
)
def doc_routing(fx: Fixtures) -> DataFrame:
    key = F.col("ID") % 3
    kind = F.when(key == 0, "Pdmarticle").when(key == 1, fixed.FILE_CONTENT_TYPE).otherwise("User")
    docs = fx.items.select("ID", "LanguageID", kind.alias("item_type"))
    search = route_documents(docs, searchable=True).withColumnsRenamed(
        {"document_set": "search_set", "document_id": "search_id"}
    )
    common = route_documents(search, per_language=False).withColumnsRenamed(
        {"document_set": "common_set", "document_id": "common_id"}
    )
    return route_documents(common).select(
        "ID", "LanguageID", "document_set", "search_set", "document_id", "common_set", "common_id"
    )


@query(
    "split_by_language",
    """
WITH d AS (SELECT ID, LanguageID, CASE WHEN StateID > 40 THEN upper(Label) ELSE Label END AS Label FROM {fx_items}
  WHERE NOT (StateID BETWEEN 10 AND 12))
SELECT concat('export_pdmarticle_', LanguageID) AS document_set, CAST(ID AS VARCHAR) AS document_id, Label FROM d
UNION ALL SELECT concat('export_pdmarticle_search_', LanguageID), CAST(ID AS VARCHAR), Label FROM {fx_items}""",
)
def split_by_language(fx: Fixtures) -> DataFrame:
    path = shared_dir(fx.spark, "documents")
    docs = fx.items.select("ID", "LanguageID", "Label", "StateID", F.lit("Pdmarticle").alias("item_type"))
    write_documents(docs, path)
    write_documents(docs, path, searchable=True)
    # Some documents come again with another label, some are taken out; the searchable sets keep theirs.
    write_documents(docs.where("StateID > 40").withColumn("Label", F.upper("Label")), path)
    write_documents(docs.where("StateID BETWEEN 10 AND 12"), path, deleted=True)
    return read_documents(fx.spark, path).select("document_set", "document_id", "Label")


@query(
    "content_raw",
    """
SELECT doc_id, text AS content, CASE WHEN length(text) > 200 THEN concat(left(text, 100), ' ', right(text, 100))
 ELSE text END AS raw FROM documents""",
)
def content_raw(fx: Fixtures) -> DataFrame:
    docs = fx.table("documents").select("doc_id", F.col("text").alias("_Content"))
    return docs_ops.with_excerpt(docs).select(
        "doc_id", F.col("_Content").alias("content"), F.col("_ContentRaw").alias("raw")
    )
