"""SQL of the derived views, for the engine that checks results."""

VIEWS: dict[str, str] = {
    "fx_languages": """
SELECT * FROM (VALUES (1, 'en', 0), (2, 'de', 1), (3, 'fr', 0)) AS t(ID, ShortName, IsDefault)""",
    "fx_items": """
SELECT p.p_partkey + 1 AS ID, CAST(l.ID AS BIGINT) AS LanguageID, l.ShortName AS LanguageShortName,
 concat(p.p_name, ' [', l.ShortName, ']') AS Label,
 CAST(floor(p.p_partkey / 10.0) AS BIGINT) AS ParentID,
 CASE WHEN p.p_size % 5 = 0 THEN 1 ELSE 0 END AS IsFolder,
 concat(' ', CAST(100 + p.p_size % 5 AS VARCHAR), ' ', CAST(200 + p.p_size % 7 AS VARCHAR), ' ') AS ClassMapping,
 concat(' ', CAST(CAST(floor(p.p_partkey / 10.0) AS BIGINT) AS VARCHAR), ' ', CAST(p.p_partkey + 1 AS VARCHAR), ' ')
   AS _Parents,
 CAST(p.p_size AS BIGINT) AS StateID, CAST(p.p_size % 4 AS BIGINT) AS WorkflowID,
 CAST(p.p_size % 10 AS BIGINT) AS AuthorID, concat('user', CAST(p.p_size % 10 AS VARCHAR)) AS Author,
 concat('P-', CAST(p.p_partkey + 1 AS VARCHAR)) AS ExternalKey,
 p.p_partkey % 3 AS CopyOf, CAST(p.p_size % 6 AS BIGINT) AS CheckoutUser,
 CAST(DATE '1998-01-01' + CAST(p.p_size AS INTEGER) AS TIMESTAMP) AS CreationDate,
 CAST(DATE '1999-01-01' + CAST(p.p_size * 7 AS INTEGER) AS TIMESTAMP) AS LastChange
FROM part p CROSS JOIN {fx_languages} l""",
    "fx_item_values": """
SELECT i.ID, i.LanguageID, a.AttributeID,
 CASE a.AttributeID WHEN 13 THEN p.p_brand WHEN 43 THEN p.p_type WHEN 44 THEN CAST(p.p_size AS VARCHAR) END AS Value,
 CASE a.AttributeID WHEN 13 THEN p.p_brand WHEN 43 THEN lower(p.p_type)
   WHEN 44 THEN concat(CAST(p.p_size AS VARCHAR), ' kg') END AS FormattedValue
FROM {fx_items} i JOIN part p ON p.p_partkey + 1 = i.ID
CROSS JOIN (SELECT * FROM (VALUES (13), (43), (44)) AS t(AttributeID)) a""",
    "fx_lines": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_quantity,
 l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey
 ORDER BY l_partkey, l_linenumber, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax,
 l_returnflag, l_linestatus) AS line_id FROM lineitem""",
    "fx_references": """
SELECT l_orderkey AS ItemID, 'Order' AS SourceType, CAST(2 AS BIGINT) AS LanguageID,
 CAST(30 + l_linenumber % 3 AS BIGINT) AS AttributeID, line_id AS ReferenceID, l_orderkey AS _SubitemID,
 l_partkey + 1 AS TargetID, 'Part' AS TargetType, CAST(l_linenumber AS BIGINT) AS SortOrder FROM {fx_lines}""",
    "fx_row_references": """
SELECT o.o_custkey AS ItemID, 'Customer' AS SourceType, CAST(2 AS BIGINT) AS LanguageID,
 CAST(30 + l.l_linenumber % 3 AS BIGINT) AS AttributeID, l.line_id AS ReferenceID,
 o.o_orderkey + 1000000 AS _SubitemID, l.l_partkey + 1 AS TargetID, 'Part' AS TargetType,
 CAST(l.l_linenumber AS BIGINT) AS SortOrder
FROM {fx_lines} l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "fx_subtables": """
SELECT o_custkey AS ItemID, 'Customer' AS ItemType, CAST(2 AS BIGINT) AS LanguageID,
 CAST(191 AS BIGINT) AS AttributeID, o_orderkey + 1000000 AS ItemTableID, o_custkey AS _SubitemID,
 CAST(0 AS BIGINT) AS SortOrder, o_orderstatus AS Value FROM orders
UNION ALL SELECT o.o_custkey, 'Customer', 2, 192, 1000000000 + l.line_id, o.o_orderkey + 1000000,
 CAST(l.l_linenumber AS BIGINT), l.l_returnflag
FROM {fx_lines} l JOIN orders o ON o.o_orderkey = l.l_orderkey
UNION ALL SELECT o.o_custkey, 'Customer', 2, 193, 10000000000000 + l.line_id, 1000000000 + l.line_id, 0,
 concat(l.l_returnflag, '193') FROM {fx_lines} l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE l.l_linenumber % 2 = 1
UNION ALL SELECT o.o_custkey, 'Customer', 2, 194, 20000000000000 + l.line_id, 10000000000000 + l.line_id, 0,
 concat(l.l_returnflag, '194') FROM {fx_lines} l JOIN orders o ON o.o_orderkey = l.l_orderkey
 WHERE l.l_linenumber % 4 = 1""",
    "fx_changes": """
SELECT event_id + CASE WHEN event_id % 5 = 0 THEN 40 ELSE 0 END AS seq, event_id, user_id AS ID,
 epoch_us(ts) AS InsertTime,
 CASE WHEN event_type = 'error' AND event_id % 50 = 0 THEN 2 WHEN event_type = 'signup' THEN 3 ELSE 1 END AS Action,
 CASE event_type WHEN 'purchase' THEN 0 WHEN 'view' THEN 2 WHEN 'click' THEN 3 ELSE 4 END AS JMSPriority,
 (event_id % 4) * 2 AS ProducerStatus, props AS Message, event_type,
 CASE (user_id + event_id % 2) % 4 WHEN 0 THEN 'Pdmarticle' WHEN 1 THEN 'Pdmarticlestructure' WHEN 2 THEN 'Mamfile' ELSE 'User' END
   AS item_type,
 CASE event_id % 7 WHEN 0 THEN 'Configuration' WHEN 1 THEN 'Mapping' WHEN 2 THEN 'FileContent' ELSE 'Item' END
   AS type
FROM events""",
    "fx_sent": """
SELECT *, CASE WHEN JMSPriority = 0 THEN CASE type WHEN 'Configuration' THEN 8 WHEN 'Mapping' THEN 8
 WHEN 'FileContent' THEN 6 ELSE 7 END ELSE JMSPriority END AS sent_priority FROM {fx_changes}""",
    "fx_judged": """
SELECT *, CASE WHEN Action IN (2, 3) OR type IN ('Configuration', 'Mapping') THEN 'valid'
 WHEN coalesce(max(CASE WHEN Action = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY item_type, type, ID ORDER BY seq, event_id
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 THEN 'tombstoned'
 WHEN InsertTime = max(CASE WHEN Action <> 2 THEN InsertTime END) OVER (PARTITION BY item_type, type, ID ORDER BY seq, event_id
   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) THEN 'valid' ELSE 'stale' END AS verdict FROM {fx_changes}""",
    "fx_state": """
SELECT l.item_type, l.type, l.ID, l.Message, l.InsertTime AS _LastWritten, c.created AS _InsertTime,
 CASE WHEN l.Action = 3 THEN 1 ELSE 0 END AS _IsCreated
FROM (SELECT *, row_number() OVER (PARTITION BY item_type, type, ID ORDER BY seq DESC, event_id DESC) AS rn
 FROM {fx_judged} WHERE verdict = 'valid' AND type IN ('Item', 'FileContent')) l
LEFT JOIN (SELECT item_type, type, ID, InsertTime AS created FROM (SELECT j.*, row_number() OVER (
 PARTITION BY j.item_type, j.type, j.ID ORDER BY seq DESC, event_id DESC) AS rn FROM {fx_judged} j WHERE Action IN (2, 3)) WHERE rn = 1 AND Action = 3) c
 ON c.ID = l.ID AND c.item_type = l.item_type AND c.type = l.type
WHERE l.rn = 1 AND l.Action <> 2""",
    "fx_subscriptions": """
SELECT concat('consumer-', CAST(ID AS VARCHAR)) AS SubscriberName, concat(item_type, '/', type) AS ItemType,
 min(2 + 2 * (ID % 8 // 4)) AS ProducerID FROM {fx_changes} GROUP BY 1, 2""",
    "fx_order_items": """
SELECT o_orderkey AS ID, CAST(2 AS BIGINT) AS LanguageID, 'de' AS LanguageShortName, o_orderpriority AS Label,
 o_custkey AS ParentID,
 CAST(CASE o_orderstatus WHEN 'O' THEN 10 WHEN 'F' THEN 60 ELSE 40 END AS BIGINT) AS StateID,
 o_custkey % 4 AS WorkflowID, concat('O-', CAST(o_orderkey AS VARCHAR)) AS ExternalKey, o_custkey % 5 AS CopyOf,
 concat(' ', CAST(300 + o_custkey % 3 AS VARCHAR), ' ') AS ClassMapping,
 CAST(o_orderdate AS TIMESTAMP) AS _LastWritten,
 CAST(o_orderdate AS TIMESTAMP) - INTERVAL 30 DAY AS _InsertTime FROM orders""",
    "fx_attributes": """
SELECT CAST(1 + r_regionkey AS BIGINT) AS ID, CAST(0 AS BIGINT) AS ParentID, r_name AS Label, '' AS ExternalKey,
 1 AS IsFolder, 0 AS IsLink, 0 AS _TypeID, '' AS PropertyValues, '' AS ParamA, '' AS ParamB FROM region
UNION ALL SELECT 100 + n_nationkey, 1 + n_regionkey, n_name, concat('N-', CAST(n_nationkey AS VARCHAR)),
 1, 0, 0, '', '', '' FROM nation
UNION ALL SELECT 1000 + s_suppkey, 100 + s_nationkey, s_name,
 CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE concat('S-', CAST(s_suppkey - s_suppkey % 2 AS VARCHAR)) END,
 0, CASE WHEN s_suppkey % 11 = 0 THEN 1 ELSE 0 END, CAST(1 + s_suppkey % 3 AS INTEGER),
 concat('{"unit":"u', CAST(s_suppkey % 9 AS VARCHAR), '","decimals":', CAST(s_suppkey % 4 AS VARCHAR), '}'),
 concat('a', CAST(s_suppkey AS VARCHAR)), concat('b', CAST(s_nationkey AS VARCHAR)) FROM supplier""",
    "fx_class_attributes": """
SELECT CAST(100 + n_nationkey % 5 AS BIGINT) AS ClassID, CAST(10 + n_nationkey AS BIGINT) AS AttributeID FROM nation
UNION SELECT 200 + n_nationkey % 7, 10 + n_nationkey FROM nation
UNION SELECT 0, 10 + n_nationkey FROM nation WHERE n_nationkey < 3
UNION SELECT 300, 30 FROM nation UNION SELECT 301, 31 FROM nation UNION SELECT 302, 30 FROM nation
UNION SELECT 302, 32 FROM nation UNION SELECT 400 + n_nationkey % 2, 191 FROM nation""",
    "fx_class_kinds": """
SELECT CAST(10 + n_nationkey AS BIGINT) AS ID, CAST(n_nationkey % 4 AS INTEGER) AS _TypeID FROM nation
WHERE 10 + n_nationkey NOT IN (30, 31, 32)
UNION SELECT 30, 2 FROM nation UNION SELECT 31, 2 FROM nation UNION SELECT 32, 2 FROM nation
UNION SELECT 191, 3 FROM nation""",
    "fx_customer_items": """
SELECT c_custkey AS ID, CAST(2 AS BIGINT) AS LanguageID, c_name AS Label, c_mktsegment AS Segment,
 concat(' ', CAST(400 + c_custkey % 3 AS VARCHAR), ' ') AS ClassMapping, c_custkey + 5 AS _ExtensionID FROM customer""",
    "fx_deleted": """
SELECT DISTINCT CASE WHEN ID % 2 = 0 THEN 'Pdmarticle' ELSE 'Mamfile' END AS item_type,
 CASE WHEN ID % 9 = 0 THEN 'WorkflowID' ELSE 'StateID' END AS field,
 CASE WHEN ID % 9 = 0 THEN ID % 4 ELSE ID % 60 END AS value FROM {fx_changes} WHERE Action = 2""",
    "fx_headers": """
SELECT s_name AS ItemType, CASE WHEN s_suppkey % 4 = 3 THEN 'Configuration' ELSE 'item' END AS Type,
 CAST(s_suppkey AS VARCHAR) AS k, CAST(s_nationkey AS VARCHAR) AS n,
 CASE WHEN s_suppkey % 2 = 0 THEN 'html' ELSE 'text' END AS kind FROM supplier""",
}
