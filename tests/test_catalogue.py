"""The read API on a small hand-written catalogue, in the shapes users ask for."""

import pytest
from pyspark.sql import functions as F

from tidemark import Catalogue, Criteria
from tidemark.operators import apply, cascade, catalog, documents, evolve, feed, language, subscriptions, tree

ITEMS = (
    "ID bigint, LanguageID bigint, LanguageShortName string, Label string, ParentID bigint, StateID bigint, "
    "WorkflowID bigint, ClassMapping string, _Parents string, ExternalKey string, _LastWritten string, "
    "_InsertTime string, attrs map<bigint,struct<value:string,formatted:string>>"
)


@pytest.fixture(scope="module")
def shop(spark):
    rows = []
    for i, parent, classes, key in [(1, 0, " 102 421 ", "A"), (2, 1, "102", "B"), (3, 1, "", "C"), (4, 2, None, "")]:
        for lang, short in ((1, "en"), (2, "de")):
            rows.append(
                (i, lang, short, f"Größe {i} {short}", parent, i * 20, i % 2, classes, f" {parent} {i} ", key,
                 f"2018-03-{10 + i} 00:00:00", f"2017-03-{10 + i} 00:00:00", {13: (f"v{i}", f"V{i}"), -4: ("p", "P")})
            )
    items = spark.createDataFrame(rows, ITEMS).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("_LastWritten", "_InsertTime")}
    )
    languages = spark.createDataFrame([(1, "en", 0), (2, "de", 1)], "ID int, ShortName string, IsDefault int")
    attributes = spark.createDataFrame(
        [(1, 0, "root", "", 0, 0), (13, 1, "Brand", "brand", 0, 1), (30, 1, "Link", "link", 0, 2),
         (191, 1, "Rows", "rows", 0, 3), (102, 1, "Class", "cls", 1, 1), (14, 13, "Sub", "brand", 0, 1)],
        "ID bigint, ParentID bigint, Label string, ExternalKey string, IsLink int, _TypeID int",
    )
    mapping = spark.createDataFrame(
        [(102, 13), (102, 30), (421, 191), (421, 14), (0, 14)], "ClassID bigint, AttributeID bigint"
    )
    return Catalogue(items, languages, attributes, mapping)


def ids(df):
    return sorted(r["ID"] for r in df.select("ID").collect())


def test_filters(shop):
    assert ids(shop.item_ids(Criteria().class_id(102))) == [1, 2]
    assert ids(shop.item_ids(Criteria().class_id(102).ancestor(1).state_id(50, "<"))) == [1, 2]
    assert ids(shop.item_ids(Criteria().label("Größe 2 de"))) == [2]
    assert ids(shop.item_ids(Criteria().label("Größe 2 en"))) == []
    assert ids(shop.item_ids(Criteria().label("Größe 2 en").language_short_name("en"))) == [2]
    assert ids(shop.item_ids(Criteria().external_key(""))) == [4]
    assert ids(shop.item_ids(Criteria().custom_attribute(13, "V3").user_defined("StateID > 50"))) == [3]
    assert len(ids(shop.items_by_filter(Criteria()))) == 4


def test_long_id_lists_are_joined(shop):
    assert ids(shop.item_ids(Criteria().item_ids(range(2, 3000)))) == [2, 3, 4]
    frame = shop.items.sparkSession.range(1, 2).withColumnRenamed("id", "ID")
    assert ids(shop.item_ids(Criteria().item_ids(frame).item_ids([4]))) == [1, 4]


def test_unknown_comparison():
    with pytest.raises(ValueError):
        Criteria().state_id(1, "!=")


def test_since(shop):
    assert ids(shop.updated_since("2018-03-12 00:00:00")) == [3, 4]
    assert ids(shop.updated_since("2018-03-12 00:00:00", Criteria().external_key("C"))) == [3]
    assert ids(shop.created_since("2017-03-13 00:00:00", Criteria().workflow_id(0))) == [4]


def test_lookups(shop):
    assert [r["LanguageShortName"] for r in shop.item_by_external_key("B").orderBy("LanguageID").collect()] == ["en", "de"]
    assert shop.item_by_id(99).count() == 0
    assert shop.value("13", ["Label"]).where("ID = 3").first()["value"] == "v3"
    assert shop.value("-4", ["Label"], formatted=True).first()["value"] == "P"
    assert shop.value("Label", ["Label"]).where("ID = 1 AND LanguageID = 1").first()["value"] == "Größe 1 en"
    assert {r["field"] for r in shop.values(["Label"]).collect()} == {"Label", "13", "-4"}
    assert {(r["name"], r["field_class"]) for r in shop.fields().collect()} >= {
        ("13", "custom"), ("-4", "custom"), ("-4", "plugin"), ("Label", "standard"),
    }
    bundle = {r["ID"]: r["languages"] for r in shop.iterate(Criteria().class_id(102), [1, 2])}
    assert set(bundle) == {1, 2} and bundle[1][2]["Label"] == "Größe 1 de"


def test_trees(shop, spark):
    assert ids(shop.descendants(1, 1)) == [2, 3]
    assert ids(shop.descendants(1, 0)) == [2, 3, 4]
    assert ids(shop.attribute_tree(0, 1)) == [1, 13, 30, 191]
    assert ids(shop.attribute_tree(13)) == [13, 14]
    ring = spark.createDataFrame([(1, 3), (2, 1), (3, 2)], "ID bigint, ParentID bigint")
    start = spark.createDataFrame([(1,)], "ID bigint")
    assert ids(tree.descendants(ring, start)) == [1, 2, 3]


def test_attributes(shop):
    lists = {r["ClassMapping"]: r["attribute_ids"] for r in shop.effective_attributes().collect()}
    assert lists == {" 102 421 ": [-4, 13, 14], "102": [-4, 13], "": [-4, 14], None: [-4, 14]}
    keys = {r["ExternalKey"]: r["AttributeID"] for r in catalog.ids_by_external_key(shop.attributes).collect()}
    assert keys["brand"] == 14 and "" not in keys
    assert ids(shop.attribute_by_external_key("link")) == [30]
    assert {r["ParentID"]: r["children"] for r in catalog.children(shop.attributes).collect()} == {
        0: [1], 1: [13, 30, 191], 13: [14],
    }


def test_overlay_and_fan_out(spark):
    rows = spark.createDataFrame(
        [(1, 0, {"LanguageID": "0", "13:Value": "all"}), (1, 1, {"LanguageID": "1", "13:Value": "own", "L": "x"}),
         (1, 2, {"LanguageID": "2"}), (2, 1, {"LanguageID": "1", "L": "y"})],
        "ID bigint, LanguageID bigint, fields map<string,string>",
    )
    merged = {(r["ID"], r["LanguageID"]): r["fields"] for r in language.overlay(rows).collect()}
    assert merged == {
        (1, 1): {"LanguageID": "1", "13:Value": "all", "L": "x"}, (1, 2): {"LanguageID": "2", "13:Value": "all"},
        (2, 1): {"LanguageID": "1", "L": "y"},
    }
    refs = spark.createDataFrame([(1, 0, 7), (1, 2, 8)], "ItemID bigint, LanguageID bigint, r bigint")
    copied = language.fan_out(refs, rows.where("LanguageID > 0").select("ID", "LanguageID"))
    assert sorted((r["LanguageID"], r["r"]) for r in copied.collect()) == [(1, 7), (2, 7), (2, 8)]


def test_upsert_keeps_the_create_time(spark):
    schema = "seq bigint, event_id bigint, ID bigint, Action int, InsertTime bigint, Message string"
    first = spark.createDataFrame([(1, 1, 1, 3, 10, "a"), (2, 2, 2, 3, 11, "b"), (3, 3, 3, 1, 12, "c")], schema)
    store = apply.upsert_items(None, apply.latest(first, ("ID",)), ("ID",))
    second = spark.createDataFrame(
        [(4, 4, 1, 1, 20, "a2"), (5, 5, 2, 2, 21, ""), (6, 6, 4, 3, 22, "d"), (7, 7, 5, 3, 23, "e"), (8, 8, 5, 2, 24, "")],
        schema,
    )
    got = {r["ID"]: tuple(r)[1:] for r in apply.upsert_items(store, apply.latest(second, ("ID",)), ("ID",)).collect()}
    assert got == {1: ("a2", 20, 10, 0), 3: ("c", 12, None, 0), 4: ("d", 22, 22, 1)}


def test_missing_fields_get_defaults(spark):
    rows = spark.createDataFrame([(1, {"n": "5"})], "ID bigint, fields map<string,string>")
    got = apply.typed_columns(rows, "fields", {"n": "int", "m": "bigint", "t": "text", "d": "timestamp", "l": "list<int>"})
    assert tuple(got.first()) == (1, 5, 0, "", None, [])


def test_mapping_is_emptied_by_class_minus_one(spark):
    have = spark.createDataFrame([(1, 1)], "ClassID bigint, AttributeID bigint")
    schema = "seq bigint, event_id bigint, ID bigint, Message string"
    pairs = lambda rows: sorted(tuple(r) for r in apply.apply_mapping(have, spark.createDataFrame(rows, schema)).collect())
    assert pairs([(1, 1, 2, "5, 6")]) == [(1, 1), (2, 5), (2, 6)]
    assert pairs([(1, 1, 2, "5"), (2, 2, -1, ""), (3, 3, 3, "7,7")]) == [(3, 7)]


def test_cascades(spark):
    items = spark.createDataFrame(
        [(1, 1, 5, 50), (2, 1, 6, 60), (3, 2, 7, 50)], "ID bigint, LanguageID bigint, WorkflowID bigint, StateID bigint"
    )
    gone = spark.createDataFrame([("WorkflowID", 6), ("StateID", 50)], "field string, value bigint")
    assert {r["ID"]: (r["WorkflowID"], r["StateID"]) for r in cascade.clear_workflows(items, gone).collect()} == {
        1: (0, 0), 2: (0, 0), 3: (0, 0),
    }
    assert ids(cascade.affected_items(items, gone, "WorkflowID")) == [2]
    assert ids(cascade.drop_languages(items, spark.createDataFrame([(1,)], "LanguageID bigint"))) == [3]


def test_reindex_fields():
    rule = documents.reindex_fields
    assert rule(None, ["30"], ["191"], ["Label", "ID"]) == (["ID", "Label"], ["30"], ["191"])
    assert rule(["13", "30", "99"], ["30", "31"], ["191"], ["Label"]) == (
        ["13:Value", "13:FormattedValue", "99:Value", "99:FormattedValue"], ["30"], [],
    )


def test_stores_grow_and_shrink(spark):
    old = spark.createDataFrame([(1, "a", "x")], "ID bigint, Label string, Gone string")
    new = spark.createDataFrame([(2, "b", 5)], "ID bigint, Label string, Size int")
    both = evolve.evolve(old, new, ("Gone",))
    assert evolve.columns_of(both) == {"ID": "bigint", "Label": "string", "Size": "int"}
    assert sorted(tuple(r) for r in both.collect()) == [(1, "a", None), (2, "b", 5)]
    columns = spark.createDataFrame([("ID", "bigint"), ("Classes", "array<int>")], "field string, column_type string")
    assert evolve.struct_type(columns).simpleString() == "struct<Classes:array<int>,ID:bigint>"
    assert evolve.lookup_table(old.withColumn("StateID", F.lit(1)), "StateID", "User") is None


def test_subscriptions(spark):
    subs = spark.createDataFrame(
        [("a", "User", 2), ("b", "User", 4), ("c", "User", 2)], "SubscriberName string, ItemType string, ProducerID int"
    )
    assert subscriptions.consumer_mask(subs, "User").first()["mask"] == 6
    assert subscriptions.consumer_mask(subs, "Language").first()["mask"] == -1
    log = spark.createDataFrame([(1, "User"), (2, "Mamfile")], "ID bigint, item_type string")
    assert ids(subscriptions.unheard(log, subs)) == [2]
    again = spark.createDataFrame([("a", "User", 8), ("d", "User", 8)], subs.schema)
    assert {(r[0], r[2]) for r in subscriptions.upsert(subs, again).collect()} == {("a", 2), ("b", 4), ("c", 2), ("d", 8)}


def test_taken_rows_are_purged_when_all_have_them(spark):
    log = spark.createDataFrame(
        [(1, 10, 4), (2, 10, 0), (3, 99, 4)], "ID bigint, InsertTime bigint, ProducerStatus int"
    )
    taken = spark.createDataFrame([(1, 50), (2, 50), (3, 50)], "ID bigint, high_water bigint")
    left = feed.purge(feed.mark_taken(log, taken, 2), 6).collect()
    assert {r["ID"]: r["ProducerStatus"] for r in left} == {2: 2, 3: 4}
