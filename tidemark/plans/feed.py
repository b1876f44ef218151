"""Queries over the change log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.labels import byte_size, duration, is_taken, operation_label
from tidemark.operators import feed, subscriptions
from tidemark.operators.apply import latest, upsert_items
from tidemark.operators.freshness import fresh, judge, of_items
from tidemark.operators.notices import coalesced
from tidemark.plans.fixtures import Fixtures, text
from tidemark.plans.registry import query
from tidemark.session import shared_dir
from tidemark.sources.logs import mean_times, processing_times, read_log
from tidemark.streaming.consumers import Consumer

ARRIVAL = ("seq", "event_id")
MINUTE_MS = 60_000
QUIET_MS = 60 * MINUTE_MS


@query(
    "cdc_poll",
    """
SELECT event_id, ID, InsertTime, Action, JMSPriority, CAST(sent_priority AS INTEGER) AS sent_priority,
 CASE WHEN JMSPriority = 0 THEN 0 ELSE 1 END AS export_type
FROM {fx_sent} WHERE Action IN (1, 2, 3, 4) AND (ProducerStatus & 2) = 0
ORDER BY JMSPriority DESC, seq, event_id LIMIT 50""",
)
def cdc_poll(fx: Fixtures) -> DataFrame:
    return feed.outgoing(feed.poll(fx.changes, 2, ARRIVAL)).select(
        "event_id", "ID", "InsertTime", "Action", "JMSPriority", "sent_priority", "export_type"
    )


@query(
    "batch_high_water",
    """
SELECT event_id, batch, max(InsertTime) OVER (PARTITION BY batch ORDER BY rk ROWS UNBOUNDED PRECEDING) AS high_water,
 max(InsertTime) OVER (PARTITION BY batch) AS batch_newest
FROM (SELECT *, CAST((rk - 1) // 50 AS BIGINT) AS batch FROM (
 SELECT *, row_number() OVER (ORDER BY JMSPriority DESC, seq, event_id) AS rk FROM {fx_changes}
 WHERE Action IN (1, 2, 3, 4) AND (ProducerStatus & 2) = 0))""",
)
def batch_high_water(fx: Fixtures) -> DataFrame:
    rows = feed.in_batches(fx.changes, 2, ARRIVAL)
    newest = rows.groupBy("batch").agg(F.max("InsertTime").alias("batch_newest"))
    return rows.join(newest, "batch").select("event_id", "batch", "high_water", "batch_newest")


@query(
    "change_routing",
    """
SELECT event_id, item_type, CAST(sent_priority AS INTEGER) AS sent_priority FROM {fx_sent}
WHERE item_type IN ('Pdmarticle', 'Mamfile') AND event_id % 3 IN (0, 1) AND sent_priority NOT IN (7, 8)""",
)
def change_routing(fx: Fixtures) -> DataFrame:
    addressed = (
        F.when(F.col("event_id") % 3 == 0, fixed.PRIMARY_CORRELATION)
        .when(F.col("event_id") % 3 == 1, "DocumentSubscriber")
        .otherwise("OtherSubscriber")
    )
    routed = feed.route(
        fx.sent.withColumn("correlation_id", addressed),
        ["Pdmarticle", "Mamfile"],
        "DocumentSubscriber",
        handles_initial=False,
    )
    return routed.select("event_id", "item_type", "sent_priority")


@query(
    "op_label",
    """
SELECT event_id, concat(CASE WHEN sent_priority IN (7, 8, 9) THEN 'Initial' WHEN Action = 1 THEN 'Update'
 WHEN Action = 2 THEN 'Delete' WHEN Action = 3 THEN 'Create' ELSE '' END, type) AS label FROM {fx_sent}""",
)
def op_label(fx: Fixtures) -> DataFrame:
    return fx.sent.select("event_id", operation_label("Action", "sent_priority", "type").alias("label"))


@query(
    "consumer_mask",
    """
SELECT m.ItemType, CAST(m.mask AS BIGINT) AS mask, c.waiting_2, c.waiting_4, c.complete
FROM (SELECT ItemType, sum(DISTINCT ProducerID) AS mask FROM {fx_subscriptions} GROUP BY 1) m
JOIN (SELECT concat(item_type, '/', type) AS ItemType,
 count(*) FILTER (WHERE (ProducerStatus & 2) = 0) AS waiting_2,
 count(*) FILTER (WHERE (ProducerStatus & 4) = 0) AS waiting_4,
 count(*) FILTER (WHERE (ProducerStatus & 6) = 6) AS complete
 FROM {fx_changes} GROUP BY 1) c USING (ItemType)""",
)
def consumer_mask(fx: Fixtures) -> DataFrame:
    waiting = fx.changes.groupBy(F.concat_ws("/", "item_type", "type").alias("ItemType")).agg(
        F.count_if(~is_taken("ProducerStatus", 2)).alias("waiting_2"),
        F.count_if(~is_taken("ProducerStatus", 4)).alias("waiting_4"),
        F.count_if(is_taken("ProducerStatus", 2) & is_taken("ProducerStatus", 4)).alias("complete"),
    )
    return subscriptions.consumer_masks(fx.subscriptions).join(waiting, "ItemType")


@query(
    "consumer_purge",
    """
WITH polled AS (SELECT ID, InsertTime FROM {fx_changes} WHERE Action IN (1, 2, 3, 4) AND (ProducerStatus & 2) = 0
 ORDER BY JMSPriority DESC, seq, event_id LIMIT 50),
 high AS (SELECT max(InsertTime) AS h FROM polled),
 marked AS (SELECT event_id, ProducerStatus + CASE WHEN ID IN (SELECT ID FROM polled)
  AND InsertTime <= (SELECT h FROM high) AND (ProducerStatus & 2) = 0 THEN 2 ELSE 0 END AS ProducerStatus
  FROM {fx_changes})
SELECT event_id, CAST(ProducerStatus AS INTEGER) AS ProducerStatus FROM marked WHERE ProducerStatus <> (
 SELECT coalesce(sum(DISTINCT ProducerID), -1) FROM {fx_subscriptions} WHERE ItemType = 'Mamfile/Item')""",
)
def consumer_purge(fx: Fixtures) -> DataFrame:
    polled = feed.poll(fx.changes, 2, ARRIVAL)
    high = polled.agg(F.max("InsertTime").alias("high_water"))
    taken = polled.select("ID").withColumn("high_water", high.scalar())
    mask = subscriptions.consumer_mask(fx.subscriptions, "Mamfile/Item").scalar()
    return feed.purge(feed.mark_taken(fx.changes, taken, 2), mask).select("event_id", "ProducerStatus")


@query("stale_filter", "SELECT event_id, verdict FROM {fx_judged}")
def stale_filter(fx: Fixtures) -> DataFrame:
    return judge(fx.changes).select("event_id", "verdict")


@query("apply_upsert", "SELECT * FROM {fx_state}")
def apply_upsert(fx: Fixtures) -> DataFrame:
    return upsert_items(None, latest(fresh(fx.changes).where(of_items())))


@query(
    "reinitialise",
    """
WITH marked AS (SELECT *, CASE WHEN Action = 2 AND event_id % 250 = 0 THEN 4 ELSE Action END AS act FROM {fx_changes}),
 cut AS (SELECT item_type, max(InsertTime) AS c FROM marked WHERE act = 4 GROUP BY 1)
SELECT event_id, m.item_type, m.act AS Action FROM marked m LEFT JOIN cut ON cut.item_type = m.item_type
WHERE c IS NULL OR InsertTime >= c""",
)
def reinitialise(fx: Fixtures) -> DataFrame:
    action = F.when((F.col("Action") == 2) & (F.col("event_id") % 250 == 0), 4).otherwise(F.col("Action"))
    return feed.reinitialise(fx.changes.withColumn("Action", action)).select("event_id", "item_type", "Action")


@query(
    "type_order",
    """
SELECT item_type, CASE WHEN item_type = 'Language' THEN 0 ELSE 1 END AS rank FROM (
 SELECT DISTINCT CASE WHEN ID % 11 = 0 THEN 'Language' ELSE item_type END AS item_type FROM {fx_changes})""",
)
def type_order(fx: Fixtures) -> DataFrame:
    types = fx.changes.select(
        F.when(F.col("ID") % 11 == 0, "Language").otherwise(F.col("item_type")).alias("item_type")
    )
    return feed.types_in_order(types)


@query(
    "took_mean",
    """
SELECT service, count(*) AS n, CAST(sum(ms) // count(*) AS BIGINT) AS mean_ms FROM (
 SELECT CASE WHEN event_id % 2 = 0 THEN 'Cassandra' ELSE 'Elasticsearch' END AS service,
  CAST(floor(value) AS BIGINT) AS ms FROM events WHERE event_type IN ('view', 'click', 'purchase')) GROUP BY 1""",
)
def took_mean(fx: Fixtures) -> DataFrame:
    event = F.col("event_type")
    who = F.when(event == "signup", "SocketSubscriber").when(F.col("event_id") % 2 == 0, "MasterSubscriber").otherwise(
        "ElasticSubscriber"
    )
    what = F.when(event == "error", "Failed to update").otherwise("Successfully updated")
    line = F.format_string(
        "%s INFO [%s] %s data with id %d. Took(ms) %d", text("ts"), who, what, "event_id",
        F.floor("value").cast("bigint"),
    )
    path = shared_dir(fx.spark, "log")
    fx.table("events").select(line.alias("value")).write.text(path)
    return mean_times(processing_times(read_log(fx.spark, path)))


@query(
    "notify_coalesce",
    f"""
WITH n AS (SELECT item_type, Action, event_id, InsertTime // 1000 AS at_ms FROM {{fx_changes}}),
 gaps AS (SELECT *, CASE WHEN at_ms - lag(at_ms) OVER w > {QUIET_MS} OR lag(at_ms) OVER w IS NULL THEN 1 ELSE 0 END
  AS opens FROM n WINDOW w AS (PARTITION BY item_type ORDER BY at_ms, event_id)),
 ses AS (SELECT *, sum(opens) OVER (PARTITION BY item_type ORDER BY at_ms, event_id ROWS UNBOUNDED PRECEDING) AS s
  FROM gaps),
 fl AS (SELECT *, (row_number() OVER (PARTITION BY item_type, s ORDER BY at_ms, event_id) - 1) // 100 AS f FROM ses),
 lots AS (SELECT *, count(*) OVER (PARTITION BY item_type, s, f) AS pending FROM fl)
SELECT item_type, -1 AS notice_type, count(*) AS pending, CAST(min(at_ms) AS BIGINT) AS first_ms,
 CAST(max(at_ms) AS BIGINT) AS last_ms FROM lots WHERE pending > 3 GROUP BY item_type, s, f
UNION ALL SELECT item_type, Action, 1, CAST(at_ms AS BIGINT), CAST(at_ms AS BIGINT) FROM lots WHERE pending <= 3""",
)
def notify_coalesce(fx: Fixtures) -> DataFrame:
    notices = fx.changes.withColumn("at_ms", F.floor(F.col("InsertTime") / 1000).cast("bigint"))
    chunk = F.floor(F.col("at_ms") / MINUTE_MS)
    return coalesced(notices, ["item_type"], "at_ms", ["event_id"], chunk, quiet_ms=QUIET_MS)


@query(
    "subscription_types",
    """
SELECT 'producer 2' AS asked, ItemType FROM (SELECT DISTINCT ItemType FROM {fx_subscriptions} WHERE ProducerID = 2)
UNION ALL SELECT 'consumer-1', ItemType FROM
 (SELECT DISTINCT ItemType FROM {fx_subscriptions} WHERE SubscriberName = 'consumer-1')""",
)
def subscription_types(fx: Fixtures) -> DataFrame:
    by_producer = subscriptions.subscribed_types(fx.subscriptions, F.col("ProducerID") == 2)
    by_name = subscriptions.subscribed_types(fx.subscriptions, F.col("SubscriberName") == "consumer-1")
    return by_producer.select(F.lit("producer 2").alias("asked"), "ItemType").unionByName(
        by_name.select(F.lit("consumer-1").alias("asked"), "ItemType")
    )


@query(
    "subscription_upsert",
    """
WITH base AS (SELECT * FROM {fx_subscriptions} WHERE ItemType LIKE '%/Item'),
 inc AS (SELECT SubscriberName, ItemType, CAST(8 AS BIGINT) AS ProducerID FROM {fx_subscriptions}
  WHERE SubscriberName LIKE '%5'),
 leaving AS (SELECT DISTINCT concat('consumer-', CAST(ID AS VARCHAR)) AS SubscriberName FROM {fx_changes}
  WHERE Action = 2)
SELECT SubscriberName, ItemType, CAST(ProducerID AS BIGINT) AS ProducerID FROM (
 SELECT * FROM base UNION ALL SELECT * FROM inc i WHERE NOT EXISTS (
  SELECT 1 FROM base b WHERE b.SubscriberName = i.SubscriberName AND b.ItemType = i.ItemType)) u
WHERE SubscriberName NOT IN (SELECT SubscriberName FROM leaving)""",
)
def subscription_upsert(fx: Fixtures) -> DataFrame:
    base = fx.subscriptions.where(F.col("ItemType").endswith("/Item"))
    incoming = fx.subscriptions.where(F.col("SubscriberName").endswith("5")).withColumn(
        "ProducerID", F.lit(8).cast("bigint")
    )
    leaving = fx.changes.where(F.col("Action") == 2).select(
        F.concat(F.lit("consumer-"), text("ID")).alias("SubscriberName")
    ).distinct()
    return subscriptions.remove(subscriptions.upsert(base, incoming), leaving)


@query(
    "removed_types",
    """
SELECT SubscriberName, ItemType FROM {fx_subscriptions} EXCEPT
SELECT concat('consumer-', CAST(ID AS VARCHAR)), concat(item_type, '/', type) FROM {fx_changes}
WHERE event_type = 'purchase'""",
)
def removed_types(fx: Fixtures) -> DataFrame:
    wanted = fx.changes.where(F.col("event_type") == "purchase").select(
        F.concat(F.lit("consumer-"), text("ID")).alias("SubscriberName"),
        F.concat_ws("/", "item_type", "type").alias("ItemType"),
    )
    return subscriptions.removed_types(fx.subscriptions, wanted)


@query(
    "custom_consumer",
    """
SELECT kind, ID, count(*) AS n, CAST(sum(k) AS BIGINT) AS k FROM (
 SELECT CASE WHEN Action = 2 THEN 'delete' WHEN type IN ('Configuration', 'Mapping') THEN 'configuration'
  WHEN event_id % 5 = 3 THEN 'record' ELSE 'item' END AS kind, ID,
  CASE WHEN Action <> 2 AND type NOT IN ('Configuration', 'Mapping') AND event_id % 5 <> 3
   THEN CAST(json_extract_string(Message, '$.k') AS BIGINT) ELSE 0 END AS k
 FROM {fx_sent} WHERE item_type IN ('Pdmarticle', 'User') AND sent_priority NOT IN (7, 8)) GROUP BY 1, 2""",
)
def custom_consumer(fx: Fixtures) -> DataFrame:
    changes = fx.sent.withColumns(
        {
            "correlation_id": F.lit(fixed.PRIMARY_CORRELATION),
            "message_kind": F.when(F.col("event_id") % 5 == 3, "Record").otherwise("Item"),
            "fields": F.from_json("Message", "map<string,string>"),
        }
    )

    def count(k):
        return lambda df: df.groupBy("ID").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("k"))

    none = F.lit(0).cast("bigint")
    consumer = Consumer(
        "ReportSubscriber",
        ["Pdmarticle", "User"],
        on_item=count(F.col("fields")["k"].cast("bigint")),
        on_record=count(none),
        on_configuration=count(none),
        on_delete=count(none),
        handles_initial=False,
    )
    parts = [df.select(F.lit(kind).alias("kind"), "ID", "n", "k") for kind, df in consumer.process(changes).items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "human_units",
    """
SELECT o_orderkey,
 CASE WHEN v < 1024 THEN concat(CAST(v AS VARCHAR), ' Bytes')
  WHEN v < 1048576 THEN concat(CAST(v // 1024 AS VARCHAR), ' KB')
  WHEN v < 1073741824 THEN concat(CAST(v // 1048576 AS VARCHAR), ' MB')
  WHEN v < 1099511627776 THEN concat(CAST(v // 1073741824 AS VARCHAR), ' GB')
  ELSE concat(CAST(v // 1099511627776 AS VARCHAR), ' TB') END AS size,
 concat(CAST(ms // 3600000 AS VARCHAR), 'h ', CAST(ms // 60000 % 60 AS VARCHAR), 'm ',
  CAST(ms // 1000 % 60 AS VARCHAR), 's ', CAST(ms % 1000 AS VARCHAR), 'ms') AS took
FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS ms, CAST(floor(o_totalprice) AS BIGINT) *
 CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 4096 WHEN 2 THEN 16777216 ELSE 1 END
 // CASE o_orderkey % 4 WHEN 3 THEN 400 ELSE 1 END AS v FROM orders)""",
)
def human_units(fx: Fixtures) -> DataFrame:
    ms = F.floor("o_totalprice").cast("bigint")
    key = F.col("o_orderkey") % 4
    v = (
        F.when(key == 1, ms * 4096)
        .when(key == 2, ms * 16777216)
        .when(key == 3, F.floor(ms / 400))
        .otherwise(ms)
    )
    return fx.table("orders").select("o_orderkey", byte_size(v).alias("size"), duration(ms).alias("took"))


@query(
    "unheard_logs",
    """
SELECT event_id FROM {fx_changes} WHERE concat(item_type, '/', type) NOT IN
 (SELECT ItemType FROM {fx_subscriptions} WHERE SubscriberName IN ('consumer-1', 'consumer-2'))""",
)
def unheard_logs(fx: Fixtures) -> DataFrame:
    """Log rows of types that none of two consumers listens to."""
    heard = fx.subscriptions.where(F.col("SubscriberName").isin("consumer-1", "consumer-2"))
    log = fx.changes.select("event_id", F.concat_ws("/", "item_type", "type").alias("item_type"))
    return subscriptions.unheard(log, heard).select("event_id")
