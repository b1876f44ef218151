"""Text, date and number expressions over whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.coerce import date_shadow, date_valid, numeric_shadow
from tidemark.functions.text import (
    base_type, big_value, capitalised, html_text, raw_keyword, search_tokens, store_name,
)
from tidemark.operators.apply import typed_columns
from tidemark.plans.fixtures import Fixtures, micros, text
from tidemark.plans.registry import query

# Tags are taken out piece by piece here: what follows a "<" up to the next ">" goes if it starts like a tag.
HTML_SQL = (
    "trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace("
    "array_to_string(list_transform(string_split(regexp_replace({c}, "
    "'(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', ' ', 'g'), '<'), lambda p, i: CASE "
    "WHEN i = 1 THEN p WHEN contains(p, '>') AND (left(p, 1) IN ('/', '!', '?') OR lower(left(p, 1)) BETWEEN 'a' AND 'z') "
    "THEN concat(' ', substr(p, instr(p, '>') + 1)) ELSE concat('<', p) END), ''), "
    "'&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&apos;', ''''), '&#39;', ''''), "
    "'&nbsp;', ' '), '&copy;', '©'), '&reg;', '®'), '&middot;', '·'), '&amp;', '&'), '\\s+', ' ', 'g'))"
)


@query("html_strip", f"SELECT page_id, {HTML_SQL.replace('{c}', 'html')} AS text FROM pages")
def html_strip(fx: Fixtures) -> DataFrame:
    return fx.table("pages").select("page_id", html_text("html").alias("text"))


@query(
    "search_tokens",
    f"""
SELECT * FROM (
 SELECT 'page' AS origin, page_id AS id, unnest(regexp_split_to_array(lower({HTML_SQL.replace('{c}', 'html')}), '\\s+'))
  AS token FROM pages
 UNION ALL SELECT 'document', doc_id, unnest(regexp_split_to_array(lower({HTML_SQL.replace('{c}', 'text')}), '\\s+'))
  FROM documents) WHERE token <> ''""",
)
def tokens(fx: Fixtures) -> DataFrame:
    pages = fx.table("pages").select(
        F.lit("page").alias("origin"), F.col("page_id").alias("id"), F.explode(search_tokens("html")).alias("token")
    )
    docs = fx.table("documents").select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("id"), F.explode(search_tokens("text")).alias("token")
    )
    return pages.unionByName(docs)


@query(
    "big_value_trim",
    """
SELECT doc_id, CASE WHEN length(text) > 10922 THEN concat(left(text, 5461), right(text, 5461)) ELSE text END AS value
FROM documents""",
)
def big_value_trim(fx: Fixtures) -> DataFrame:
    return fx.table("documents").select("doc_id", big_value("text").alias("value"))


# Formats the orders' dates are rendered in, as the SQL side undoes them.
RENDERED = [
    "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm", "dd/MM/yyyy", "yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy HH:mm", "yyyy.MM.dd",
    "dd.MM.yyyy HH:mm:ss", "MM/dd/yy",
]


@query(
    "typed_shadow",
    """
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + to_seconds(CAST(o_custkey % 86400 AS INTEGER)) AS t,
 o_totalprice, o_orderkey % 12 AS m FROM orders)
SELECT o_orderkey, epoch_us(CASE m
 WHEN 0 THEN t WHEN 1 THEN date_trunc('minute', t) WHEN 2 THEN date_trunc('day', t) WHEN 3 THEN t
 WHEN 4 THEN date_trunc('minute', t) WHEN 5 THEN date_trunc('day', t) WHEN 6 THEN t
 WHEN 7 THEN CASE WHEN year(t) < 2000 THEN date_trunc('day', t + INTERVAL 100 YEAR) ELSE date_trunc('day', t) END
 WHEN 8 THEN date_trunc('year', t) WHEN 9 THEN t WHEN 10 THEN date_trunc('second', t) ELSE NULL END) AS date_us,
 CASE WHEN m = 8 THEN CAST(year(t) AS DOUBLE) WHEN m = 10 THEN CAST(epoch_ms(t) AS DOUBLE) ELSE NULL END AS number,
 CASE WHEN m = 11 THEN 'no date' END AS keyword FROM d""",
)
def typed_shadow(fx: Fixtures) -> DataFrame:
    t = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=(F.col("o_custkey") % 86400).cast("decimal(18,6)"))
    m = F.col("o_orderkey") % 12
    rendered = F.when(m == 8, F.date_format(t, "yyyy")).when(m == 9, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"))
    rendered = rendered.when(m == 10, text(F.unix_millis(t)))
    for i, fmt in enumerate(RENDERED):
        rendered = rendered.when(m == i, F.date_format(t, fmt))
    value = rendered.otherwise("No Date")
    return fx.table("orders").select("o_orderkey", m.alias("m"), value.alias("v")).select(
        "o_orderkey",
        F.unix_micros(date_shadow("v")).alias("date_us"),
        numeric_shadow("v").alias("number"),
        F.when(F.col("m") == 11, raw_keyword("v")).alias("keyword"),
    )


@query(
    "raw_keywords",
    """
SELECT doc_id, md5(CASE WHEN length(text) <= 10922 THEN lower(text) END) AS keyword FROM documents
UNION ALL SELECT -o_orderkey, md5(lower(priority)) FROM (SELECT o_orderkey, o_orderpriority AS priority FROM orders)""",
)
def raw_keywords(fx: Fixtures) -> DataFrame:
    """Texts long and short; a value above the keyword size has none."""
    return fx.table("documents").select("doc_id", F.md5(raw_keyword("text")).alias("keyword")).unionByName(
        fx.table("orders").select((-F.col("o_orderkey")).alias("doc_id"), F.md5(raw_keyword("o_orderpriority")).alias("keyword"))
    )


@query(
    "coerce_types",
    """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS INTEGER) ELSE 0 END AS amount,
 CASE WHEN o_orderkey % 4 = 3 THEN 0 ELSE o_orderkey * 3 END AS big,
 CASE o_orderkey % 3 WHEN 0 THEN epoch_us(CAST(o_orderdate AS TIMESTAMP)) WHEN 1 THEN NULL
  ELSE epoch_us(TIMESTAMP '2024-01-02 03:04:05') END AS changed,
 CASE WHEN o_orderkey % 4 = 3 THEN '' ELSE o_orderpriority END AS label,
 CASE WHEN o_orderkey % 4 = 3 THEN '' ELSE concat(o_custkey % 9, ',', o_custkey % 7) END AS classes,
 CASE WHEN o_orderkey % 4 = 3 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS price
FROM orders""",
)
def coerce_types(fx: Fixtures) -> DataFrame:
    key = F.col("o_orderkey")
    amount = F.when(key % 4 == 0, text("o_custkey")).when(key % 4 == 1, F.lit("")).when(key % 4 == 2, F.lit("null"))
    changed = F.when(key % 3 == 0, F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd"))
    changed = changed.when(key % 3 == 1, F.lit("0000-00-00 00:00:00")).otherwise("toTimestamp(now())")
    full = F.create_map(
        F.lit("amount"), amount, F.lit("big"), text(key * 3), F.lit("changed"), changed,
        F.lit("label"), F.col("o_orderpriority"), F.lit("classes"),
        F.format_string(" %d %d ", F.col("o_custkey") % 9, F.col("o_custkey") % 7), F.lit("price"), text("o_totalprice"),
    )
    fields = F.when(key % 4 == 3, F.create_map(F.lit("changed"), changed)).otherwise(full)
    types = {
        "amount": "int", "big": "bigint", "changed": "timestamp", "label": "text", "classes": "list<int>",
        "price": "double",
    }
    now = F.lit("2024-01-02 03:04:05").cast("timestamp")
    typed = typed_columns(fx.table("orders").select("o_orderkey", fields.alias("fields")), "fields", types, now)
    return typed.select(
        "o_orderkey", "amount", "big", micros("changed").alias("changed"), "label",
        F.array_join("classes", ",").alias("classes"), "price",
    )


@query(
    "date_valid",
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 1) OR (o_orderkey % 5 = 2 AND
 TRY_CAST(concat(year(o_orderdate), '-02-', right(concat('0', 25 + o_custkey % 7), 2)) AS DATE) IS NOT NULL)
 THEN 1 ELSE 0 END AS valid FROM orders""",
)
def valid_dates(fx: Fixtures) -> DataFrame:
    key, day = F.col("o_orderkey") % 5, F.col("o_orderdate").cast("timestamp")
    value = (
        F.when(key.isin(0, 1), F.date_format(day, "yyyy-MM-dd"))
        .when(key == 2, F.format_string("%s-02-%02d", F.date_format(day, "yyyy"), 25 + F.col("o_custkey") % 7))
        .when(key == 3, F.date_format(day, "dd/MM/yyyy"))
    )
    return fx.table("orders").select("o_orderkey", date_valid(value, "yyyy-MM-dd").cast("int").alias("valid"))


@query(
    "type_names",
    """
SELECT event_id, CASE WHEN item_type = 'Pdmarticlestructure' THEN 'Pdmarticle' ELSE item_type END AS base,
 concat(upper(substr(event_type, 1, 1)), substr(event_type, 2)) AS capital,
 concat('export_', lower(item_type)) AS item_store,
 CASE event_id % 2 WHEN 0 THEN 'export_reference' ELSE concat('export_', CASE WHEN item_type = 'Pdmarticlestructure'
  THEN 'pdmarticle' ELSE lower(item_type) END, '_subtable') END AS side_store FROM {fx_changes}""",
)
def type_names(fx: Fixtures) -> DataFrame:
    side = F.when(F.col("event_id") % 2 == 0, "Reference").otherwise("Subtable")
    return fx.changes.select(
        "event_id", base_type("item_type").alias("base"), capitalised("event_type").alias("capital"),
        store_name("item_type").alias("item_store"), store_name("item_type", side).alias("side_store"),
    )
