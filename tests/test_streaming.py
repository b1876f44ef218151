"""Streams: state over restarts, redelivery, user code per kind, coalesced notices."""

import glob
import random
import time

from pyspark.sql import functions as F

from test_ordered import SCHEMA, expected_verdicts, feed
from tidemark.operators.apply import latest, upsert_items
from tidemark.operators.criteria import Criteria
from tidemark.operators.freshness import fresh
from tidemark.sources.changes import stream_changes
from tidemark.sources.sinks import json_writer, write_documents
from tidemark.streaming.apply import FeedState, apply_batch, rebuild, start
from tidemark.streaming.consumers import Consumer
from tidemark.operators.notices import coalesced, in_lots
from tidemark.streaming.notices import NoticeSink, coalesce_batch, coalesce_stream, read_notices, session_notices


def test_feed_over_restarts_and_redelivery(spark, tmp_path):
    rows = feed(240, 9)
    state = FeedState(spark, str(tmp_path / "state"), ("ID",))
    for part in (rows[:90], rows[90:91], rows[91:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        start(stream_changes(spark, str(tmp_path / "in"), schema=SCHEMA), state).awaitTermination()
    verdicts = {r["event_id"]: r["verdict"] for r in spark.read.parquet(state.accepted).collect()}
    assert verdicts == expected_verdicts(rows)
    want = {tuple(r) for r in upsert_items(None, latest(fresh(spark.createDataFrame(rows, SCHEMA), keys=("ID",)), ("ID",)), ("ID",)).collect()}
    assert {tuple(r) for r in state.items.read().collect()} == want
    # The last batch once more: same rows, accepted and stored.
    apply_batch(state, spark.createDataFrame(rows[91:], SCHEMA), 2)
    assert {tuple(r) for r in state.items.read().collect()} == want
    again = {r["event_id"]: r["verdict"] for r in spark.read.parquet(state.accepted).collect()}
    assert again == verdicts


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    state = FeedState(spark, str(tmp_path / "state"), ("ID",))
    first = [(i, i, i, 3, i, f"m{i}") for i in range(300)]
    apply_batch(state, spark.createDataFrame(first, SCHEMA), 0)

    def files():
        return {f for f in glob.glob(f"{state.root}/*/rows/bucket=*/*.parquet")}

    before = files()
    later = [(400, 400, 7, 1, 900, "newer"), (401, 401, 8, 2, 901, "")]
    apply_batch(state, spark.createDataFrame(later, SCHEMA), 1)
    gone = {f.split("/rows/")[1].split("/")[0] for f in before - files()}
    assert len(before & files()) > 0.9 * len(before) and 0 < len(gone) <= 2
    got = {r["ID"]: r["Message"] for r in state.items.read().collect()}
    assert len(got) == 299 and got[7] == "newer" and 8 not in got
    # Staged rows of earlier batches are gone.
    assert [f.rsplit("/", 1)[1] for f in glob.glob(f"{state.root}/items/staged/*")] == ["batch=1"]


def test_rebuild_starts_a_new_store(spark, tmp_path):
    log = [(i, i, i % 5, 1, i, f"m{i}", "User") for i in range(40)] + [(40, 40, 9, 4, 20, "start", "User")]
    schema = SCHEMA + ", item_type string"
    state = rebuild(spark, str(tmp_path / "new"), spark.createDataFrame(log, schema), ("ID",))
    assert {r["ID"]: r["Message"] for r in state.items.read().collect()} == {
        0: "m35", 1: "m36", 2: "m37", 3: "m38", 4: "m39", 9: "start",
    }
    later = [(50, 50, 1, 1, 99, "newer", "User"), (51, 51, 2, 1, 3, "stale", "User")]
    spark.createDataFrame(later, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    start(stream_changes(spark, str(tmp_path / "in"), schema=schema), state).awaitTermination()
    got = {r["ID"]: r["Message"] for r in state.items.read().collect()}
    assert (got[1], got[2], got[9]) == ("newer", "m37", "start")


def test_language_filters_prune_the_store(spark, tmp_path):
    rows = spark.range(60).selectExpr("id AS ID", "id % 3 AS LanguageID", "concat('l', id) AS Label", "id AS StateID")
    rows.write.partitionBy("LanguageID").parquet(str(tmp_path / "items"))
    found = Criteria().label("l8").apply(spark.read.parquet(str(tmp_path / "items")), 2)
    plan = found.select("ID")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(LanguageID" in plan and "PushedFilters: [IsNotNull(Label), EqualTo(Label,l8)]" in plan
    assert "StateID" not in plan.split("ReadSchema")[1]
    assert [r["ID"] for r in found.collect()] == [8]


def test_consumer_runs_its_own_code(spark, tmp_path):
    rows = [
        (1, "User", "Item", "Item", 1, "ExportPrimary", 4, {"43:Value": "x", "L": "a"}),
        (2, "User", "Item", "Record", 3, "Mine", 4, {"L": "b"}),
        (3, "User", "Configuration", "Item", 1, "ExportPrimary", 4, {"L": "c"}),
        (4, "User", "Item", "Item", 2, "ExportPrimary", 4, {"L": "d"}),
        (5, "User", "Item", "Item", 1, "Other", 4, {"L": "e"}),
        (6, "Mamfile", "Item", "Item", 1, "ExportPrimary", 4, {"L": "f"}),
        (7, "User", "Item", "Item", 1, "ExportPrimary", 7, {"L": "g"}),
    ]
    schema = (
        "ID bigint, item_type string, type string, message_kind string, Action int, correlation_id string, "
        "sent_priority int, fields map<string,string>"
    )
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    calls = []
    consumer = Consumer(
        "Mine", ["User"], on_item=lambda df: df.withColumn("keys", F.array_join(F.map_keys("fields"), ",")),
        handles_initial=False, dropped_attributes=[43],
        on_initialise=lambda: calls.append("start"), on_cleanup=lambda: calls.append("stop"),
    )
    out = str(tmp_path / "out")

    def sink(kind, df, batch_id):
        df.withColumn("kind", F.lit(kind)).write.mode("overwrite").parquet(f"{out}/{kind}/batch={batch_id}")

    stream = stream_changes(spark, str(tmp_path / "in"), schema=schema)
    consumer.start(stream, str(tmp_path / "cp"), sink).awaitTermination()
    got = {k: sorted(r["ID"] for r in spark.read.parquet(f"{out}/{k}").collect()) for k in
           ("item", "record", "configuration", "delete")}
    assert got == {"item": [1], "record": [2], "configuration": [3], "delete": [4]}
    assert spark.read.parquet(f"{out}/item").first()["keys"] == "L" and calls == ["start", "stop"]


def test_session_notices(spark, tmp_path):
    rows = [("a", f"2024-01-01 00:00:{s:02d}") for s in (1, 2, 3, 4, 30, 31)] + [("a", "2024-01-01 02:00:00")]
    df = spark.createDataFrame(rows, "k string, at string").withColumn("at", F.col("at").cast("timestamp"))
    out = session_notices(df, ["k"], "at", "1 minute").orderBy("session_start").collect()
    assert [(r["pending"], r["mass_notices"], r["single_notices"]) for r in out] == [(4, 1, 0), (2, 0, 2), (1, 0, 1)]


def test_live_coalescing_flushes_at_a_hundred_and_when_quiet(spark, tmp_path):
    rng, at, rows = random.Random(1), 0, []
    for i in range(260):
        at += rng.choice([1, 2])
        rows.append(("hot", at, i, 1))
    rows += [("cold", 1, 900, 3), ("cold", 2, 901, 1)]
    path = str(tmp_path / "in")
    schema = "notice_key string, at_ms bigint, event_id bigint, Action int"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(schema).parquet(path)
    sink = NoticeSink(spark, str(tmp_path / "out"), quiet_ms=1000)
    query = coalesce_stream(stream, sink)

    def told():
        if not glob.glob(f"{sink.notices}/batch=*/notice_key=*"):
            return []
        return sorted((r["notice_key"], r["notice_type"], r["pending"]) for r in read_notices(sink).collect())

    try:
        end = time.time() + 60
        while time.time() < end and len(told()) < 5:
            time.sleep(1)
    finally:
        query.stop()
    assert told() == [("cold", 1, 1), ("cold", 3, 1), ("hot", -1, 60), ("hot", -1, 100), ("hot", -1, 100)]


def test_live_coalescing_of_one_type_equals_the_batch_form_however_it_arrives(spark, tmp_path):
    rng, at, rows = random.Random(2), 0, []
    for i in range(1500):
        at += rng.choice([1, 1, 2, 3, 30 if i % 50 == 0 else 4])
        rows.append(("User", at, i, rng.choice([1, 2, 3])))
    schema = "notice_key string, at_ms bigint, event_id bigint, Action int"
    df = spark.createDataFrame(rows, schema)
    want = sorted(tuple(r) for r in coalesced(df, ["notice_key"], "at_ms", ["event_id"], None, quiet_ms=20).collect())
    sink = NoticeSink(spark, str(tmp_path / "out"), quiet_ms=20, hot_rows=200)
    borders = [0, 260, 300, 1100, 1500]
    for n, (low, high) in enumerate(zip(borders, borders[1:])):
        part = df.where((F.col("event_id") >= low) & (F.col("event_id") < high))
        coalesce_batch(sink, part, n)
        if n == 2:
            # The batch is delivered again.
            coalesce_batch(sink, part, n)
        left = sink.pending(n + 1)
        assert left.count() <= 99
    coalesce_batch(sink, df.limit(0), len(borders), close=True)
    columns = ["notice_key", "notice_type", "pending", "first_ms", "last_ms"]
    assert sorted(tuple(r) for r in read_notices(sink).select(*columns).collect()) == want
    # One type has all changes, and no task more than a chunk of them.
    lots = in_lots(df, ["notice_key"], "at_ms", ["event_id"], None, quiet_ms=20, hot_rows=200)
    per_task = [r["count"] for r in lots.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert max(per_task) <= 200 and sum(per_task) == 1500


def test_document_writer_can_be_replaced(spark, tmp_path):
    docs = spark.createDataFrame([(1, 2, "User", "x"), (2, 1, "User", "y")], "ID bigint, LanguageID bigint, item_type string, t string")
    write_documents(docs, str(tmp_path / "json"), json_writer)
    assert {(r["document_set"], r["t"]) for r in spark.read.json(str(tmp_path / "json")).collect()} == {
        ("export_user_2", "x"), ("export_user_1", "y"),
    }
