"""Queries over message texts, headers and operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.maps import json_map
from tidemark.operators.evolve import header_columns
from tidemark.operators.messages import Stores, apply_feed
from tidemark.plans.fixtures import Fixtures, text
from tidemark.plans.registry import query
from tidemark.session import cut_lineage, shared_dir
from tidemark.sources import changes as src
from tidemark.sources.headers import fields_of_type, language_ids, read_headers, searchable_and_standard
from tidemark.streaming.feed import LOOKUPS, FeedStores, feed_batch, stream_feed


@query(
    "msg_classify",
    """
SELECT event_id, CASE WHEN type <> 'Item' OR Action = 2 THEN 'Item' ELSE CASE event_id % 6 WHEN 0 THEN 'Record'
 WHEN 1 THEN 'DebugMode' WHEN 2 THEN 'Reindex' WHEN 3 THEN 'Record' ELSE 'Item' END END AS kind FROM {fx_changes}""",
)
def msg_classify(fx: Fixtures) -> DataFrame:
    event, ident = F.col("event_id"), text("ID")
    message = (
        F.when(event % 6 == 0, F.concat(F.lit('{"Record":[{"ID":"'), ident, F.lit('"}]}')))
        .when(event % 6 == 1, F.lit('{"DebugMode":"DEBUG","Item":[]}'))
        .when(event % 6 == 2, F.concat(F.lit('{"Reindex":{"AffectedItemIDs":["'), ident, F.lit('"]}}')))
        .when(event % 6 == 3, F.lit('{"Reindex":{},"Record":null}'))
        .when(event % 6 == 4, F.lit("no json"))
        .otherwise(F.concat(F.lit('{"Item":[{"note":"Record"}],"Reference":['), F.lit("]}")))
    )
    return fx.changes.select("event_id", src.change_kind(message, "type", "Action").alias("kind"))


@query("payload_decode", "SELECT doc_id, text AS message FROM documents")
def payload_decode(fx: Fixtures) -> DataFrame:
    packed = F.when(F.col("doc_id") % 10 == 0, F.col("text")).otherwise(src.encode_payload("text"))
    log = fx.table("documents").select("doc_id", packed.alias("packed"))
    return log.select("doc_id", src.decode_payload("packed").alias("message"))


@query(
    "json_props",
    """
SELECT event_id, 'k' AS name, json_extract_string(props, '$.k') AS value FROM events""",
)
def json_props(fx: Fixtures) -> DataFrame:
    return fx.table("events").select("event_id", F.explode(json_map("props")).alias("name", "value"))


@query(
    "header_fields",
    """
SELECT CASE WHEN Type = 'item' THEN lower(ItemType) ELSE concat(lower(ItemType), '_configuration') END AS header_key,
 concat_ws(',', CASE WHEN kind = 'html' THEN concat(k, ':Value') END, concat('n', n, ':Value')) AS html_fields,
 array_to_string(list_sort(['Label', concat(k, ':Value'), 'ID', 'LastChange', 'Hits', 'Classes']), ',') AS reindexed,
 concat('30,', n) AS reference_ids, '1,2,3' AS languages FROM {fx_headers}""",
)
def header_fields(fx: Fixtures) -> DataFrame:
    header = F.col("header")
    return read_headers(fx.headers).select(
        "header_key",
        F.array_join(F.sort_array(fields_of_type(header["CustomFields"], "html")), ",").alias("html_fields"),
        F.array_join(F.sort_array(searchable_and_standard(header)), ",").alias("reindexed"),
        F.array_join(header["SearchableReferences"], ",").alias("reference_ids"),
        F.array_join(language_ids(header), ",").alias("languages"),
    )


@query(
    "schema_from_header",
    """
WITH h AS (SELECT *, CASE WHEN Type = 'item' THEN lower(ItemType) ELSE concat(lower(ItemType), '_configuration') END
 AS header_key FROM {fx_headers})
SELECT header_key, f.field, f.column_type FROM h CROSS JOIN (SELECT * FROM (VALUES ('ID', 'bigint'),
 ('Label', 'string'), ('LastChange', 'timestamp'), ('Hits', 'string'), ('Classes', 'array<int>'),
 ('_LastWritten', 'timestamp'), ('_InsertTime', 'timestamp'), ('_IsCreated', 'int')) AS t(field, column_type)) f
UNION ALL SELECT header_key, concat(k, ':Value'), 'string' FROM h
UNION ALL SELECT header_key, concat('n', n, ':Value'), 'string' FROM h""",
)
def schema_from_header(fx: Fixtures) -> DataFrame:
    return header_columns(read_headers(fx.headers))


@query(
    "op_message",
    """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'initialize' WHEN 1 THEN 'DebugMode' WHEN 2 THEN 'Reindex'
  WHEN 3 THEN 'itemTypeAdded' ELSE 'itemTypeRemoved' END AS operation,
 CASE event_id % 5 WHEN 1 THEN 'OFF' WHEN 2 THEN 'Mamfile' ELSE concat(item_type, ',User') END AS item_types,
 CASE WHEN event_id % 5 = 2 THEN concat(CAST(ID AS VARCHAR), ',', CAST(event_id AS VARCHAR)) END AS affected_ids,
 CASE WHEN event_id % 5 = 2 THEN concat('13,', CAST(ID % 50 AS VARCHAR)) END AS searchable_fields,
 CASE WHEN event_id % 5 = 0 THEN 'ParentID,StateID' END AS lookup_fields
FROM {fx_changes}""",
)
def op_message(fx: Fixtures) -> DataFrame:
    event, ident = F.col("event_id"), text("ID")
    types = F.concat(F.lit('{"Item":"'), F.col("item_type"), F.lit(', User"'))
    message = (
        F.when(event % 5 == 0, F.concat(types, F.lit(',"MVFields":{"user":["ParentID","StateID"]}}')))
        .when(event % 5 == 1, F.lit('{"DebugMode":"OFF"}'))
        .when(
            event % 5 == 2,
            F.concat(
                F.lit('{"Reindex":{"ItemType":"Mamfile","AffectedItemIDs":["'), ident, F.lit('","'), text(event),
                F.lit('"],"SearchableFields":[13,'), text(F.col("ID") % 50), F.lit("]}}"),
            ),
        )
        .otherwise(F.concat(types, F.lit("}")))
    )
    action = F.when(event % 5 == 0, 4).when(event % 5 == 4, 2).otherwise(1)
    read = fx.changes.select("event_id", src.read_operation(message, action).alias("m"))
    return read.select(
        "event_id",
        "m.operation",
        F.array_join("m.item_types", ",").alias("item_types"),
        F.array_join("m.affected_ids", ",").alias("affected_ids"),
        F.array_join("m.searchable_fields", ",").alias("searchable_fields"),
        F.array_join(F.col("m.lookup_fields")["user"], ",").alias("lookup_fields"),
    )


@query(
    "big_attr_map",
    """
SELECT event_id, l.language, CASE WHEN event_id % 3 = 1 THEN
  CASE l.language WHEN '1' THEN concat('a', CAST(ID AS VARCHAR)) ELSE 'b,c' END
 WHEN event_id % 3 = 2 THEN CASE l.language WHEN '1' THEN 'b' ELSE concat('c', CAST(ID AS VARCHAR)) END
 ELSE CASE l.language WHEN '1' THEN concat('a', CAST(ID AS VARCHAR), ',b') WHEN '3' THEN
   concat('a', CAST(ID AS VARCHAR), ',c') ELSE concat('a', CAST(ID AS VARCHAR)) END END AS attributes
FROM {fx_changes} CROSS JOIN (SELECT * FROM (VALUES ('0'), ('1'), ('2'), ('3')) AS t(language)) l
WHERE (event_id % 3 = 0) OR (event_id % 3 = 1 AND l.language IN ('1', '2')) OR
 (event_id % 3 = 2 AND l.language IN ('1', '2'))""",
)
def big_attr_map(fx: Fixtures) -> DataFrame:
    event, ident = F.col("event_id"), text("ID")
    message = (
        F.when(
            event % 3 == 0,
            F.concat(F.lit('{"_BigDataAttributes":[["a'), ident, F.lit('"],["b"],null,["c","a'), ident, F.lit('"]]}')),
        )
        .when(event % 3 == 1, F.concat(F.lit('{"_BigDataAttributes":{"1":["a'), ident, F.lit('"],"2":["b","c"]}}')))
        .otherwise(F.concat(F.lit('{"_BigDataAttributes":[null,["b"],["c'), ident, F.lit('"]]}')))
    )
    return fx.changes.select("event_id", F.explode(src.big_attributes(message)).alias("language", "names")).select(
        "event_id", "language", F.array_join(F.sort_array("names"), ",").alias("attributes")
    )


FEED_TYPES = {"Label": "text", "StateID": "int", "Hits": "bigint"}
FEED_BATCHES = 2


def feed_messages(fx: Fixtures) -> DataFrame:
    """The log with full messages: items in two languages with a language-independent row, children, configuration and
    mapping; every other message is packed."""
    event, ident = text("event_id"), text("ID")
    number = F.col("event_id")

    def quoted(*pairs: tuple[str, Column]) -> Column:
        return F.to_json(F.map_from_arrays(F.array(*[F.lit(k) for k, _ in pairs]), F.array(*[v for _, v in pairs])))

    language = lambda i: F.lit(str(i))
    items = F.concat_ws(
        ",",
        quoted(("LanguageID", language(0)), ("Label", F.concat(F.lit("L"), event)), ("13:Value", F.concat(F.lit("b"), ident))),
        quoted(("LanguageID", language(1)), ("Label", F.lit("hidden")), ("StateID", text(number % 7)), ("note", F.lit("n"))),
        quoted(("LanguageID", language(2)), ("StateID", text(number % 5)), ("Hits", event)),
    )
    reference = quoted(
        ("LanguageID", language(0)), ("AttributeID", F.lit("30")), ("CSReferenceID", event),
        ("TargetID", text(F.col("ID") * 2)), ("SortOrder", F.lit("1")),
    )
    table = quoted(("LanguageID", language(1)), ("AttributeID", F.lit("191")), ("ItemTableID", event), ("191:Value", ident))
    data = F.concat(
        F.lit('{"Item":['), items, F.lit('],"Reference":['), F.when(number % 3 == 0, reference).otherwise(F.lit("")),
        F.lit('],"Subtable":['), table, F.lit("]}"),
    )
    row = quoted(("Label", F.concat(F.lit("A"), event)), ("ParentID", text(number % 25)), ("IsFolder", text(number % 2)))
    kind = F.when(number % 4 == 0, "Reference").when(number % 4 == 1, "Subtable").otherwise("Item")
    setup = F.concat(F.lit('{"'), kind, F.lit('":['), row, F.lit("]}"))
    pairs = F.concat(text(number % 30), F.lit(", "), text(number % 17))
    message = F.when(F.col("type") == fixed.TYPE_CONFIGURATION, setup).when(F.col("type") == fixed.TYPE_MAPPING, pairs)
    message = F.coalesce(message, data)
    packed = (number % 2 == 0) & (F.col("type") != fixed.TYPE_MAPPING)
    return fx.changes.withColumn("Message", F.when(packed, src.encode_payload(F.when(packed, message))).otherwise(message))


def shown_stores(stores: Stores, *columns: str) -> DataFrame:
    """All stores but freshness as rows of text: store, owner, ID, LanguageID, content. ``columns``: further item columns."""
    owner = F.concat_ws("/", "item_type", "type")

    def shown(df: DataFrame, store: str, owner: Column, ident: str, language: Column, *content: Column) -> DataFrame:
        parts = [F.coalesce(text(c), F.lit("")) for c in content]
        return df.select(
            F.lit(store).alias("store"), owner.alias("owner"), F.col(ident).cast("bigint").alias("ID"),
            language.cast("int").alias("LanguageID"), F.concat_ws("|", *parts).alias("content"),
        )

    attrs, none = F.col("attrs"), F.lit(None)
    held = F.concat_ws("/", "SourceType", "type")
    return (
        shown(stores.items, "item", owner, "ID", F.col("LanguageID"), F.col("Label"), F.col("StateID"), F.col("Hits"),
              attrs["13:Value"], attrs["note"], F.col("_LastWritten"), F.col("_InsertTime"), F.col("_IsCreated"), *[F.col(c) for c in columns])
        .unionByName(shown(stores.references, "reference", held, "ItemID", F.col("LanguageID"), F.col("AttributeID"),
                           F.col("ReferenceID"), F.col("fields")["TargetID"], F.col("SortOrder")))
        .unionByName(shown(stores.subtables, "subtable", held, "ItemID", F.col("LanguageID"), F.col("AttributeID"),
                           F.col("ItemTableID"), F.col("fields")["191:Value"]))
        .unionByName(shown(stores.attributes, "attribute", F.lit(""), "ID", none, F.col("Label"), F.col("ParentID"),
                           F.col("IsFolder"), F.col("_TypeID")))
        .unionByName(shown(stores.class_attributes, "mapping", F.lit(""), "ClassID", none, F.col("AttributeID")))
    )


@query(
    "feed_to_store",
    """
WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_type, type, ID ORDER BY seq DESC, event_id DESC)
   AS rn FROM {fx_judged} WHERE verdict = 'valid' AND type IN ('Item', 'FileContent')) WHERE rn = 1 AND Action <> 2),
 s AS (SELECT l.*, f._InsertTime, f._IsCreated FROM l JOIN {fx_state} f ON f.item_type = l.item_type AND f.type = l.type
  AND f.ID = l.ID),
 conf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ID ORDER BY seq DESC, event_id DESC) AS rn
  FROM {fx_changes} WHERE type = 'Configuration') WHERE rn = 1),
 -- When attributes 13 and 191 were deleted last: values written before are gone.
 gone AS (SELECT max(CASE WHEN ID = 13 THEN seq * 1000000 + event_id END) AS g13,
  max(CASE WHEN ID = 191 THEN seq * 1000000 + event_id END) AS g191 FROM {fx_changes} WHERE type = 'Configuration' AND Action = 2)
SELECT 'item' AS store, concat(item_type, '/', type) AS owner, ID, g.lang AS LanguageID,
 concat('L', event_id, '|', CASE g.lang WHEN 1 THEN event_id % 7 ELSE event_id % 5 END, '|',
  CASE g.lang WHEN 1 THEN 0 ELSE event_id END, '|', CASE WHEN g13 > seq * 1000000 + event_id THEN '' ELSE concat('b', ID) END, '|', CASE g.lang WHEN 1 THEN 'n' ELSE '' END, '|', InsertTime, '|',
  coalesce(CAST(_InsertTime AS VARCHAR), ''), '|', _IsCreated) AS content
 FROM s CROSS JOIN (SELECT unnest([1, 2]) AS lang) g CROSS JOIN gone
UNION ALL SELECT 'reference', concat(item_type, '/', type), ID, g.lang, concat(30, '|', event_id, '|', ID * 2, '|', 1)
 FROM s CROSS JOIN (SELECT unnest([1, 2]) AS lang) g WHERE event_id % 3 = 0
UNION ALL SELECT 'subtable', concat(item_type, '/', type), ID, 1, concat(191, '|', event_id, '|',
 CASE WHEN g191 > seq * 1000000 + event_id THEN '' ELSE CAST(ID AS VARCHAR) END) FROM s CROSS JOIN gone
UNION ALL SELECT 'attribute', '', ID, NULL, concat(Label, '|', ParentID, '|', IsFolder, '|', _TypeID) FROM {fx_attributes}
 WHERE ID NOT IN (SELECT ID FROM conf)
UNION ALL SELECT 'attribute', '', ID, NULL, concat('A', event_id, '|', event_id % 25, '|', event_id % 2, '|',
 CASE WHEN event_id % 4 = 0 THEN 2 WHEN event_id % 4 = 1 THEN 3 WHEN event_id % 2 = 1 THEN 0 ELSE 1 END)
 FROM conf WHERE Action <> 2
UNION ALL SELECT DISTINCT 'mapping', '', ClassID, NULL, CAST(AttributeID AS VARCHAR) FROM (
 SELECT ClassID, AttributeID FROM {fx_class_attributes}
 UNION SELECT ID, unnest([event_id % 30, event_id % 17]) FROM {fx_changes} WHERE type = 'Mapping')""",
)
def feed_to_store(fx: Fixtures) -> DataFrame:
    log = cut_lineage(feed_messages(fx))
    stores = Stores(fx.attributes, fx.class_attributes)
    last = log.agg(F.max("seq")).first()[0]
    # The log arrives in slices of its order: what one batch has seen must hold for the next.
    for i in range(FEED_BATCHES):
        low, high = (last * i // FEED_BATCHES if i else -1), last * (i + 1) // FEED_BATCHES
        stores = apply_feed(stores, log.where((F.col("seq") > low) & (F.col("seq") <= high)), FEED_TYPES)
    return shown_stores(stores)


CONTROL_TYPES = {**FEED_TYPES, "WorkflowID": "bigint"}
CONTROL_SLICES = 3


def control_messages(fx: Fixtures) -> DataFrame:
    """The log with messages that bring some languages only, and control messages among them: deleted workflows, states
    and attributes, a deleted language, a removed type."""
    event, ident, number = text("event_id"), text("ID"), F.col("event_id")

    def quoted(*pairs: tuple[str, Column]) -> Column:
        return F.to_json(F.map_from_arrays(F.array(*[F.lit(k) for k, _ in pairs]), F.array(*[v for _, v in pairs])))

    def row(language: int, *pairs: tuple[str, Column]) -> Column:
        return quoted(("LanguageID", F.lit(str(language))), *pairs)

    flow = (("WorkflowID", text(number % 6)), ("StateID", text(number % 7)))
    rows = [
        F.when(number % 4 != 1, row(0, ("Label", F.concat(F.lit("L"), event)), ("13:Value", F.concat(F.lit("b"), ident)))),
        F.when(number % 5 != 3, row(1, ("Label", F.concat(F.lit("own"), event)), ("note", F.lit("n")), *flow)),
        F.when(number % 3 != 1, row(2, ("Hits", event), *flow)),
    ]
    reference = quoted(
        ("LanguageID", F.lit("0")), ("AttributeID", F.lit("30")), ("CSReferenceID", event),
        ("TargetID", text(F.col("ID") * 2)), ("SortOrder", F.lit("1")),
    )
    table = quoted(("LanguageID", F.lit("1")), ("AttributeID", F.lit("191")), ("ItemTableID", event), ("191:Value", ident))
    data = F.concat(
        F.lit('{"Item":['), F.concat_ws(",", *rows), F.lit('],"Reference":['),
        F.when(number % 2 == 0, reference).otherwise(F.lit("")), F.lit('],"Subtable":['), table, F.lit("]}"),
    )
    setup = F.concat(F.lit('{"Item":['), quoted(("Label", F.concat(F.lit("A"), event)), ("ParentID", text(number % 25))), F.lit("]}"))
    of_type = F.element_at(F.array(F.lit("Pdmarticle"), F.lit("Mamfile"), F.lit("User")), (number % 3 + 1).cast("int"))
    flow_gone, state_gone, language_gone = number % 97 == 5, number % 97 == 11, number == 7000
    type_gone, attributes_gone = number == 4900, number % 1301 == 400
    control = flow_gone | state_gone | language_gone | type_gone | attributes_gone
    value = F.when(flow_gone, text(number % 6)).otherwise(text(number % 7))
    field = F.when(flow_gone, F.lit("WorkflowID")).otherwise(F.lit("StateID"))
    message = (
        F.when(flow_gone | state_gone, F.concat_ws(", ", ident, of_type, field, value))
        .when(language_gone, F.concat_ws(", ", ident, F.lit("Pdmarticle"), F.lit("LanguageID"), F.lit("2")))
        .when(type_gone, F.lit('{"Item":"User"}'))
        .when(attributes_gone, F.lit("13, 191"))
        .when(F.col("type") == fixed.TYPE_CONFIGURATION, setup)
        .when(F.col("type") == fixed.TYPE_MAPPING, F.concat(text(number % 30), F.lit(", "), text(number % 17)))
        .otherwise(data)
    )
    packed = (number % 2 == 0) & ~control & (F.col("type") != fixed.TYPE_MAPPING)
    return fx.changes.select(
        "seq", "event_id", "ID", "InsertTime",
        F.when(flow_gone | state_gone, "Workflow").when(language_gone, "Language").otherwise(F.col("item_type")).alias("item_type"),
        F.when(flow_gone | state_gone | language_gone, fixed.TYPE_ITEM).when(type_gone, fixed.TYPE_OPERATION)
        .when(attributes_gone, fixed.TYPE_CONFIGURATION).otherwise(F.col("type")).alias("type"),
        F.when(control, fixed.ACTION_DELETE).otherwise(F.col("Action")).alias("Action"),
        F.when(packed, src.encode_payload(F.when(packed, message))).otherwise(message).alias("Message"),
    )


CONTROL_ORACLE = """
WITH log AS (SELECT seq * 1000000 + event_id AS pos, seq, event_id, ID, InsertTime,
  CASE WHEN event_id % 97 IN (5, 11) THEN 'Workflow' WHEN event_id = 7000 THEN 'Language' ELSE item_type END AS item_type,
  CASE WHEN event_id % 97 IN (5, 11) OR event_id = 7000 THEN 'Item' WHEN event_id = 4900 THEN 'Operation'
   WHEN event_id % 1301 = 400 THEN 'Configuration' ELSE type END AS type,
  CASE WHEN event_id % 97 IN (5, 11) OR event_id IN (7000, 4900) OR event_id % 1301 = 400 THEN 2 ELSE Action END AS Action
  FROM {fx_changes}),
 users_gone AS (SELECT max(pos) AS g FROM log WHERE type = 'Operation'),
 conf AS (SELECT pos, event_id, Action, unnest(CASE WHEN event_id % 1301 = 400 THEN [ID, 13, 191] ELSE [ID] END) AS ID
  FROM log WHERE type = 'Configuration'),
 gone AS (SELECT max(CASE WHEN ID = 13 THEN pos END) AS g13, max(CASE WHEN ID = 191 THEN pos END) AS g191
  FROM conf WHERE Action = 2),
 lang_gone AS (SELECT max(pos) AS g FROM log WHERE item_type = 'Language'),
 flow_gone AS (SELECT ['Pdmarticle', 'Mamfile', 'User'][event_id % 3 + 1] AS item_type,
   CASE WHEN event_id % 97 = 5 THEN 'WorkflowID' ELSE 'StateID' END AS field,
   CASE WHEN event_id % 97 = 5 THEN event_id % 6 ELSE event_id % 7 END AS value, max(pos) AS g
  FROM log WHERE item_type = 'Workflow' GROUP BY 1, 2, 3),
 live AS (SELECT log.* FROM log, users_gone WHERE item_type IN ('Pdmarticle', 'Pdmarticlestructure', 'Mamfile', 'User')
  AND type IN ('Item', 'FileContent') AND NOT (item_type = 'User' AND g IS NOT NULL AND pos < g)),
 judged AS (SELECT *, CASE WHEN Action IN (2, 3) THEN 'valid'
  WHEN coalesce(max(CASE WHEN Action = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY item_type, type, ID ORDER BY pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 THEN 'tombstoned'
  WHEN InsertTime = max(CASE WHEN Action <> 2 THEN InsertTime END) OVER (PARTITION BY item_type, type, ID ORDER BY pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) THEN 'valid' ELSE 'stale' END AS verdict FROM live),
 v AS (SELECT *, max(CASE WHEN Action = 2 THEN pos END) OVER (PARTITION BY item_type, type, ID) AS deleted
  FROM judged WHERE verdict = 'valid'),
 m AS (SELECT * FROM v WHERE Action <> 2 AND (deleted IS NULL OR pos > deleted)),
 brought AS (SELECT m.*, unnest(list_filter([CASE WHEN event_id % 5 <> 3 THEN 1 END, CASE WHEN event_id % 3 <> 1 THEN 2 END],
   lambda x: x IS NOT NULL)) AS lang FROM m),
 rows AS (SELECT item_type, type, ID, lang, max(pos) AS pos, max_by(event_id, pos) AS e, max_by(InsertTime, pos) AS written,
   max_by(CASE WHEN Action = 3 THEN 1 ELSE 0 END, pos) AS is_created,
   max_by(InsertTime, CASE WHEN Action = 3 AND NOT (lang = 2 AND coalesce(g > pos, false)) THEN pos END) AS created
  FROM brought, lang_gone GROUP BY ALL),
 kept AS (SELECT r.*, e % 6 AS wf, e % 7 AS st, EXISTS (SELECT 1 FROM flow_gone f WHERE f.item_type = r.item_type AND f.g > r.pos
   AND f.value = CASE f.field WHEN 'WorkflowID' THEN r.e % 6 ELSE r.e % 7 END) AS cleared
  FROM rows r, lang_gone WHERE NOT (lang = 2 AND g IS NOT NULL AND r.pos < g)),
 lastm AS (SELECT item_type, type, ID, max(pos) AS pos, max_by(event_id, pos) AS e FROM m GROUP BY ALL),
 attr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ID ORDER BY pos DESC) AS rn FROM conf) WHERE rn = 1)
SELECT 'item' AS store, concat(item_type, '/', type) AS owner, ID, lang AS LanguageID, concat(
  CASE WHEN e % 4 <> 1 THEN concat('L', e) WHEN lang = 1 THEN concat('own', e) ELSE '' END, '|',
  CASE WHEN cleared THEN 0 ELSE st END, '|', CASE lang WHEN 1 THEN 0 ELSE e END, '|',
  CASE WHEN e % 4 <> 1 AND NOT coalesce(g13 > pos, false) THEN concat('b', ID) ELSE '' END, '|',
  CASE lang WHEN 1 THEN 'n' ELSE '' END, '|', written, '|', coalesce(CAST(created AS VARCHAR), ''), '|', is_created, '|',
  CASE WHEN cleared THEN 0 ELSE wf END) AS content FROM kept, gone
UNION ALL SELECT 'reference', concat(item_type, '/', type), ID, lang, concat(30, '|', e, '|', ID * 2, '|', 1)
 FROM (SELECT *, unnest(list_filter([CASE WHEN e % 5 <> 3 THEN 1 END, CASE WHEN e % 3 <> 1 THEN 2 END],
   lambda x: x IS NOT NULL)) AS lang FROM lastm WHERE e % 2 = 0)
UNION ALL SELECT 'subtable', concat(item_type, '/', type), ID, 1, concat(191, '|', e, '|',
  CASE WHEN coalesce(g191 > pos, false) THEN '' ELSE CAST(ID AS VARCHAR) END) FROM lastm, gone
UNION ALL SELECT 'attribute', '', ID, NULL, concat(Label, '|', ParentID, '|', IsFolder, '|', _TypeID) FROM {fx_attributes}
 WHERE ID NOT IN (SELECT ID FROM attr)
UNION ALL SELECT 'attribute', '', ID, NULL, concat('A', event_id, '|', event_id % 25, '|', 0, '|', 1) FROM attr WHERE Action <> 2
UNION ALL SELECT DISTINCT 'mapping', '', ClassID, NULL, CAST(AttributeID AS VARCHAR) FROM (
 SELECT ClassID, AttributeID FROM {fx_class_attributes}
 UNION SELECT ID, unnest([event_id % 30, event_id % 17]) FROM log WHERE type = 'Mapping')"""


def in_slices(fx: Fixtures, log: DataFrame, slices: int = CONTROL_SLICES) -> list[DataFrame]:
    """The log cut into slices of its order."""
    last = log.agg(F.max("seq")).first()[0]
    seq = F.col("seq")
    borders = [-1, *[last * (i + 1) // slices for i in range(slices)]]
    return [log.where((seq > low) & (seq <= high)) for low, high in zip(borders, borders[1:])]


@query("feed_controls", CONTROL_ORACLE)
def feed_controls(fx: Fixtures) -> DataFrame:
    stores = Stores(fx.attributes, fx.class_attributes)
    for part in in_slices(fx, cut_lineage(control_messages(fx))):
        stores = apply_feed(stores, part, CONTROL_TYPES)
    return shown_stores(stores, "WorkflowID")


@query("stream_feed", CONTROL_ORACLE)
def stream_feed_query(fx: Fixtures) -> DataFrame:
    root = shared_dir(fx.spark, "feed")
    state = FeedStores(fx.spark, f"{root}/stores", CONTROL_TYPES, buckets=16)
    state.begin(fx.attributes, fx.class_attributes)
    log = cut_lineage(control_messages(fx))
    for part in in_slices(fx, log):
        part.write.mode("append").parquet(f"{root}/inbox")
        stream = src.stream_changes(fx.spark, f"{root}/inbox", schema=log.schema)
        stream_feed(stream, state, f"{root}/checkpoint").awaitTermination()
    return shown_stores(state.read(), "WorkflowID")


@query(
    "lookup_feed",
    """
SELECT split_part(owner, '/', 1) AS item_type, split_part(owner, '/', 2) AS type, ID, CAST(LanguageID AS BIGINT) AS LanguageID,
 f.field, split_part(content, '|', f.place) AS value FROM (""" + CONTROL_ORACLE + """) stores,
 (VALUES ('StateID', 2), ('_LastWritten', 6), ('_InsertTime', 7), ('_IsCreated', 8), ('WorkflowID', 9)) AS f(field, place)
WHERE store = 'item' AND split_part(content, '|', f.place) <> '' AND NOT (owner LIKE 'User/%' AND field IN ('StateID', 'WorkflowID'))
UNION ALL SELECT split_part(owner, '/', 1), split_part(owner, '/', 2), ID, LanguageID, 'LanguageID', CAST(LanguageID AS VARCHAR)
FROM (""" + CONTROL_ORACLE + """) stores WHERE store = 'item'""",
)
def lookup_feed(fx: Fixtures) -> DataFrame:
    state = FeedStores(fx.spark, shared_dir(fx.spark, "lookups"), CONTROL_TYPES, buckets=8, with_lookups=True)
    state.begin(fx.attributes, fx.class_attributes)
    for number, part in enumerate(in_slices(fx, cut_lineage(control_messages(fx)), 2)):
        feed_batch(state, part, number)
    return state.store(LOOKUPS).read()
