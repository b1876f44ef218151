"""The message feed: merging by language, control messages, and the same feed as a stream that dies and comes again."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.messages import Stores, apply_feed
from tidemark.sources.changes import stream_changes
from tidemark.sources.store import BucketStore
from tidemark.streaming.feed import KEYS, FeedStores, feed_batch, stream_feed

LOG = "seq bigint, event_id bigint, item_type string, type string, ID bigint, Action int, InsertTime bigint, Message string"
TYPES = {"Label": "text", "StateID": "int", "WorkflowID": "bigint"}


@pytest.fixture(scope="module")
def setup(spark):
    attributes = spark.createDataFrame(
        [(13, "a", 0, 0, 1), (14, "link", 0, 1, 1)], "ID bigint, Label string, IsFolder int, IsLink int, _TypeID int"
    )
    return attributes, spark.createDataFrame([(100, 13)], "ClassID bigint, AttributeID bigint")


def said(*rows, references=(), tables=()):
    return json.dumps({"Item": list(rows), "Reference": list(references), "Subtable": list(tables)})


def row(language, label, **further):
    return {"LanguageID": str(language), "Label": label, **further}


def reference(language, target):
    return {"LanguageID": str(language), "AttributeID": "30", "CSReferenceID": str(target), "13:Value": "r"}


def log(spark, *changes):
    """Changes (item_type, type, ID, Action, Message), in log order; each is the newest there is."""
    rows = [(i, i, t, k, ident, a, 1000 + i, m) for i, (t, k, ident, a, m) in enumerate(changes)]
    return spark.createDataFrame(rows, LOG)


def shown(stores):
    items = {
        (r["item_type"], r["ID"], r["LanguageID"]): (r["Label"], r["StateID"], r["WorkflowID"], dict(r["attrs"]), r["_IsCreated"],
                                                     r["_LastWritten"], r["_InsertTime"])
        for r in stores.items.collect()
    }
    refs = {(r["SourceType"], r["ItemID"], r["LanguageID"], r["ReferenceID"], r["fields"].get("13:Value")) for r in stores.references.collect()}
    rows = {(r["SourceType"], r["ItemID"], r["LanguageID"], r["ItemTableID"]) for r in stores.subtables.collect()}
    return items, refs, rows, {r["ID"] for r in stores.attributes.collect()}, {tuple(r) for r in stores.freshness.collect()}


CHANGES = [
    ("User", "Item", 1, 3, said(row(0, "both"), row(1, "x"), row(2, "y", StateID="4"), references=[reference(0, 7)])),
    ("User", "Item", 2, 3, said(row(1, "two", WorkflowID="5", **{"13:Value": "v", "14:Value": "w"}))),
    ("User", "Item", 1, 1, said(row(2, "new", StateID="5"), references=[reference(0, 8)])),
    ("Mamfile", "Item", 1, 3, said(row(1, "file", WorkflowID="5"), tables=[{"LanguageID": "1", "ItemTableID": "3"}])),
    ("Workflow", "Item", 5, 2, "5, User, WorkflowID, 5"),
    ("User", "Item", 3, 3, said(row(1, "later", WorkflowID="5", **{"13:Value": "old"}))),
    ("User", "Configuration", 13, 2, "13, 14"),
    ("User", "Item", 4, 3, said(row(1, "after", **{"13:Value": "new"}), references=[reference(1, 9)])),
    ("User", "Item", 2, 1, said(row(3, "third"))),
    ("Language", "Item", 3, 2, "3, User, LanguageID, 3"),
    ("User", "Item", 4, 1, said(row(3, "again"))),
    ("User", "Item", 5, 3, said(row(1, "gone"))),
    ("User", "Item", 6, 3, said(row(1, "gone too"))),
    ("User", "Item", 5, 2, "5,6"),
    ("Mamfile", "Operation", 0, 2, json.dumps({"Item": "Mamfile"})),
    ("Mamfile", "Item", 9, 3, said(row(1, "fresh start"))),
    ("User", "Mapping", 100, 1, "14, 15"),
]


@pytest.fixture(scope="module")
def at_once(spark, setup):
    return shown(apply_feed(Stores(*setup), log(spark, *CHANGES), TYPES))


def test_languages_a_message_leaves_out_stay(at_once):
    items, refs, _, attributes, _ = at_once
    # An update that brings one language leaves the other as it is; what hangs below is the last message's, in its language.
    assert items["User", 1, 1] == ("both", 0, 0, {}, 1, 1000, 1000)
    assert items["User", 1, 2] == ("new", 5, 0, {}, 0, 1002, 1000)
    assert {r for r in refs if r[1] == 1} == {("User", 1, 2, 8, None)}
    # Attribute 13 goes with all values written before, the class link 14 keeps its values.
    assert items["User", 2, 1] == ("two", 0, 0, {"14:Value": "w"}, 1, 1001, 1001)
    assert items["User", 3, 1][:4] == ("later", 0, 5, {}) and items["User", 4, 1][3] == {"13:Value": "new"}
    assert attributes == set()
    # Language 3 was deleted after the first and before the second was written.
    assert ("User", 2, 3) not in items and items["User", 4, 3][0] == "again"
    # A delete names several ids; a removed type starts anew; other types' workflows are not touched.
    assert not {k for k in items if k[1] in (5, 6)} and {k for k in items if k[0] == "Mamfile"} == {("Mamfile", 9, 1)}


@pytest.mark.parametrize("borders", [(5, 7, 14)])
def test_result_does_not_depend_on_how_the_log_is_cut(spark, setup, at_once, borders):
    changes, stores = log(spark, *CHANGES), Stores(*setup)
    for low, high in zip((0, *borders), (*borders, len(CHANGES))):
        stores = apply_feed(stores, changes.where((F.col("seq") >= low) & (F.col("seq") < high)), TYPES)
    assert shown(stores) == at_once


def test_stream_that_dies_half_way_and_comes_again(spark, setup, at_once, tmp_path, monkeypatch):
    state = FeedStores(spark, str(tmp_path / "stores"), TYPES, buckets=4)
    state.begin(*setup)
    state.begin(*setup)
    changes = log(spark, *CHANGES)
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")

    def run():
        stream_feed(stream_changes(spark, inbox, schema=LOG), state, checkpoint).awaitTermination()

    changes.where("seq < 6").coalesce(1).write.mode("append").parquet(inbox)
    run()
    changes.where("seq >= 6").coalesce(1).write.mode("append").parquet(inbox)
    put, stage = BucketStore.put, BucketStore.stage

    def dies(method, word):
        def call(self, *args, **kwargs):
            if word in self.path:
                raise RuntimeError("killed")
            return method(self, *args, **kwargs)

        return call

    # First some stores are staged and others not, then some are in place and others not.
    for name, method in (("stage", stage), ("put", put)):
        monkeypatch.setattr(BucketStore, name, dies(method, "subtables"))
        with pytest.raises(Exception):  # noqa: B017 - the stream's own error
            run()
        monkeypatch.setattr(BucketStore, name, method)
    run()
    assert shown(state.read()) == at_once
    # A batch that comes once more changes nothing.
    feed_batch(state, changes.where("seq >= 6"), 1)
    assert shown(state.read()) == at_once


def test_a_batch_without_control_messages_touches_its_buckets_only(spark, setup, tmp_path):
    state = FeedStores(spark, str(tmp_path / "stores"), TYPES, buckets=64)
    state.begin(*setup)
    feed_batch(state, log(spark, *[("User", "Item", i, 3, said(row(1, f"i{i}"))) for i in range(200)]), 0)
    before = {n: set(state.store(n).read().inputFiles()) for n in KEYS}
    one = log(spark, ("User", "Item", 7, 1, said(row(2, "seven")))).withColumn("InsertTime", F.lit(5000))
    feed_batch(state, one, 1)
    for name in ("items", "freshness"):
        after = set(state.store(name).read().inputFiles())
        assert 0 < len(before[name] - after) <= 4
    assert set(state.store("attributes").read().inputFiles()) == before["attributes"]
    assert {(r["ID"], r["LanguageID"]) for r in state.store("items").read().where("ID = 7").collect()} == {(7, 1), (7, 2)}


def test_buckets_keep_their_size_as_the_store_grows(spark, tmp_path):
    def filled(store, n, batch):
        rows = spark.range(n * 1000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        store.grow()
        store.replace(rows, batch, store.everything())
        return store.layout()[0], store.size()

    store = BucketStore(spark, str(tmp_path / "s"), ("id",), buckets=2, bucket_bytes=200_000)
    sizes = [filled(store, n, batch) for batch, n in enumerate((5, 10, 20, 20, 20))]
    assert sizes[0][0] == 2 and sizes[-1][0] >= 4
    assert all(size <= 200_000 * number for number, size in sizes[-1:])
    assert store.read().count() == 20_000 and store.read().distinct().count() == 20_000
    # Layouts given up are gone, and a store opened anew finds the one that holds.
    assert BucketStore(spark, str(tmp_path / "s"), ("id",), buckets=2).layout()[0] == sizes[-1][0]


def test_emptied_buckets_are_empty(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "s"), ("id",), buckets=4)
    rows = spark.range(40)
    store.replace(rows, 0, store.touched(rows))
    gone = rows.where("id % 2 = 0")
    left = store.read(store.touched(gone)).join(gone, "id", "left_anti").where("id > 100")
    store.replace(left, 1, store.touched(gone))
    assert store.read().count() == 0


def test_old_tombstones_are_forgotten_on_request(spark, setup, tmp_path):
    state = FeedStores(spark, str(tmp_path / "stores"), TYPES, buckets=1, forget_after=500)
    state.begin(*setup)
    feed_batch(state, log(spark, ("User", "Item", 1, 1, said(row(1, "a"))), ("User", "Item", 1, 2, "")), 0)
    assert [r["deleted"] for r in state.store("freshness").read().collect()] == [1]
    late = log(spark, ("User", "Item", 2, 1, said(row(1, "b")))).withColumn("InsertTime", F.lit(9000))
    feed_batch(state, late, 1)
    assert [(r["ID"], r["deleted"]) for r in state.store("freshness").read().collect()] == [(2, 0)]
