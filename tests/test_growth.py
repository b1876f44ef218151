"""Work that must grow no faster than its tables."""

from pyspark.sql import functions as F

from tidemark.operators import assemble, messages, ordered
from tidemark.operators.documents import build_documents
from tidemark.plans.fixtures import Fixtures
from tidemark.session import configure


def parts(spark, path, rows=400):
    """A part table in one file with a single split."""
    table = spark.range(rows).select(
        F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("T").alias("p_type"),
        (F.col("id") % 50).cast("int").alias("p_size"),
    )
    table.coalesce(1).write.parquet(f"{path}/part.parquet")
    return str(path)


def test_message_fields_are_built_on_all_cores(spark, tmp_path):
    fields = Fixtures(spark, parts(spark, tmp_path)).item_fields
    assert fields.count() == 1200
    used = fields.select(F.spark_partition_id().alias("p")).distinct().count()
    assert used >= spark.sparkContext.defaultParallelism


def test_rows_meet_only_the_deletions_of_their_own_attributes(spark):
    at = "struct<seq:bigint,event_id:bigint>"
    said = spark.range(3000).select(
        F.lit("attribute").alias("kind"), F.lit(None).cast("string").alias("item_type"), F.lit(None).cast("string").alias("field"),
        F.col("id").alias("value"), F.struct(F.lit(50).cast("bigint").alias("seq"), F.col("id").alias("event_id")).alias("at"),
    )
    done = said.unionByName(said.limit(1).withColumn("value", F.lit(None).cast("bigint")))
    rows = spark.createDataFrame(
        [
            (1, {"13:Value": "a", "13:FormattedValue": "b", "Label": "x"}, (10, 1)),
            (2, {"13:Value": "a", "Label": "x"}, (90, 1)),
            (3, {"13:Value": "a", "5000:Value": "kept"}, None),
            (4, {"Label": "x"}, None),
            (5, None, None),
        ],
        f"ID bigint, fields map<string,string>, {messages.AT} {at}",
    )
    left = messages.without_attributes(rows, done, "fields")
    assert left.columns == rows.columns
    assert {r.ID: r.fields for r in left.collect()} == {
        1: {"Label": "x"}, 2: {"13:Value": "a", "Label": "x"}, 3: {"5000:Value": "kept"}, 4: {"Label": "x"}, 5: None,
    }
    # A table of all deletions laid against every key of every row would be a scalar of the plan.
    assert "scalar-subquery" not in left._jdf.queryExecution().analyzed().toString()
    assert left.select(F.col("fields")).count() == 5


def assembled(spark):
    """Item 1's class shows nested rows of attribute 191, item 2's does not."""
    value = F.create_map(F.lit(11).cast("bigint"), F.struct(F.lit("v").alias("value"), F.lit("v").alias("formatted")))
    items = spark.createDataFrame(
        [(1, 2, "Customer", " 100 "), (2, 2, "Customer", " 200 "), (3, 2, "Order", " 100 ")],
        "ID bigint, LanguageID bigint, item_type string, ClassMapping string",
    ).withColumn("attrs", value)
    columns = "ItemID bigint, ItemType string, LanguageID bigint, AttributeID bigint, ItemTableID bigint, _SubitemID bigint"
    rows = [(i, "Customer", 2, 191, 10 * i, i) for i in (1, 2, 3)] + [(i, "Customer", 2, 192, 100 * i, 10 * i) for i in (1, 2, 3)]
    tables = spark.createDataFrame(rows, columns)
    refs = spark.createDataFrame(
        [(i, "Customer", 2, 30, 7 * i, below, 5, "Part") for i in (1, 2) for below in (i, 10 * i, 100 * i)],
        "ItemID bigint, SourceType string, LanguageID bigint, AttributeID bigint, ReferenceID bigint, _SubitemID bigint, "
        "TargetID bigint, TargetType string",
    )

    def whole(df):
        return df.select("*", F.lit(0).cast("bigint").alias("ClassID"), F.lit("").alias("ExternalKey"),
                         F.lit(0).cast("bigint").alias("SortOrder"), value.alias("attrs"))

    mapping = spark.createDataFrame([(100, 191), (200, 30)], "ClassID bigint, AttributeID bigint")
    kinds = spark.createDataFrame([(191, 3), (30, 2)], "ID bigint, _TypeID int")
    return items, mapping, kinds, whole(refs), whole(tables)


def test_nested_rows_are_built_for_owners_that_show_them(spark, monkeypatch):
    built, nest = [], assemble.with_nested_rows
    monkeypatch.setattr(assemble, "with_nested_rows", lambda rows, refs, *a, **k: built.append((rows, refs)) or nest(rows, refs, *a, **k))
    found = {r.ID: r for r in assemble.assembled_items(*assembled(spark)).collect()}
    assert {r.ItemID for r in built[0][0].collect()} == {r.ItemID for r in built[0][1].collect()} == {1}
    top = found[1].Subtable["191"][0]
    assert (top.ItemTableID, [x.ReferenceID for x in top.Reference["30"]]) == (10, [7])
    below = top.Subtable["192"][0]
    assert (below.ItemTableID, [x.ReferenceID for x in below.Reference["30"]]) == (100, [7])
    assert found[1].Reference is None and found[2].Subtable is None and found[3].Subtable is None
    assert [x.ReferenceID for x in found[2].Reference["30"]] == [14]


def test_messages_that_do_not_count_are_dropped_before_the_shuffle(spark):
    at = f"{messages.AT} struct<seq:bigint,event_id:bigint>"
    envelope = "m struct<Item:array<map<string,string>>,Reference:array<map<string,string>>,Subtable:array<map<string,string>>>"
    said = [
        ("T", "Item", i % 2 or None, 3 if i < 2 else 1, 100 + i, (i, i),
         ([{"LanguageID": "0", "s": f"s{i}"}, {"LanguageID": "1", "v": f"a{i}"}] + [{"LanguageID": "2", "v": f"b{i}"}] * (i < 4), None, None))
        for i in range(8)
    ]
    opened = spark.createDataFrame(said, f"item_type string, type string, ID bigint, Action int, InsertTime bigint, {at}, {envelope}")
    rows, last = messages.language_rows(opened), messages.last_children(opened)
    found = {(r.ID, r.LanguageID): (r.fields["v"], r.fields["s"], r._LastWritten, r._InsertTime, r._IsCreated) for r in rows.collect()}
    assert found == {
        (None, 1): ("a6", "s6", 106, 100, 0), (None, 2): ("b2", "s2", 102, 100, 0),
        (1, 1): ("a7", "s7", 107, 101, 0), (1, 2): ("b3", "s3", 103, 101, 0),
    }
    assert {(r.ID, tuple(r.m.languages)) for r in last.collect()} == {(None, (1,)), (1, (1,))}
    for df in (rows, last):
        assert "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString()


def test_affected_ids_are_worked_out_once(spark):
    items = spark.createDataFrame([(1, 2, {"L": "a"}), (2, 2, {"L": "b"})], "ID bigint, LanguageID bigint, fields map<string,string>")
    kinds = "ItemID bigint, LanguageID bigint, AttributeID bigint, {} bigint, _SubitemID bigint, SortOrder bigint, fields map<string,string>"
    rows = spark.createDataFrame([(i, 2, 191, 10 * i, i, 0, {"v": "x"}) for i in (1, 2)], kinds.format("ItemTableID"))
    refs = spark.createDataFrame([(i, 2, 30, 7 * i, i, 0, {"t": "x"}) for i in (1, 2)], kinds.format("ReferenceID"))
    affected = spark.range(2, 40, 1, 3).select(F.col("id").alias("ID"))
    docs = build_documents(items, refs, rows, affected=affected)
    assert [(r.ID, r.Subtable["191"][0].ItemTableID, r.Reference["30"][0].ReferenceID) for r in docs.collect()] == [(2, 20, 14)]
    assert "Range (" not in docs._jdf.queryExecution().optimizedPlan().toString()


def test_keys_are_counted_in_bounded_groups(spark):
    """A task that reads many keys holds counts of buckets, not of keys; keys that are hot are still all found."""
    names = "k bigint, s string"
    rows = spark.createDataFrame([(i, "x") for i in range(400)] + [(7, "x")] * 30 + [(None, None)] * 25 + [(9, None)] * 20, names)
    found = {tuple(r) for r in ordered.hot_keys(rows, ["k", "s"], 20).collect()}
    assert found == {(7, "x"), (None, None)}
    none = ordered.hot_keys(rows, ["k", "s"], 31)
    assert none.columns == ["__h_k", "__h_s"] and none.isEmpty()
    written = []
    many = spark.range(200_000, numPartitions=1).select(F.col("id").alias("k"))
    cut = ordered.cut_lineage
    try:
        ordered.cut_lineage = lambda df: written.append(df) or cut(df)
        ordered.hot_keys(many, ["k"])
    finally:
        ordered.cut_lineage = cut
    # The only count is of buckets.
    assert len(written) == 1 and "__h_k" not in written[0].columns
    assert ordered.KEY_BUCKETS < 200_000


def test_tasks_read_small_splits(spark, tmp_path):
    """60 MB in one file, in row groups: a task that groups as it reads gets no more than 32 MB of it."""
    rows = spark.range(6_000_000, numPartitions=1).select(F.xxhash64("id").alias("k"))
    rows.write.option("parquet.block.size", 4 << 20).parquet(f"{tmp_path}/t.parquet")
    held = spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        assert Fixtures(configure(spark), str(tmp_path)).table("t").rdd.getNumPartitions() >= 2
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum") if held is None else spark.conf.set("spark.sql.files.minPartitionNum", held)


def test_shares_of_a_shuffle_do_not_grow_with_the_table(spark):
    """Two partitions are asked for, but 60 MB are dealt to as many tasks as keep a task's share small."""
    configure(spark)
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        rows = spark.range(4_000_000).select("id", F.xxhash64("id").alias("v"))
        tasks = rows.repartition("id").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    assert tasks >= 4
