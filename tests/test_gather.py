"""Nesting keeps every row, however big an owner is."""

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.operators import assemble, places
from tidemark.operators.assemble import by_level, with_nested_rows
from tidemark.operators.documents import build_documents
from tidemark.operators.gather import gather, in_parts
from tidemark.session import configure, cut_by_key

ROWS = "ItemID bigint, LanguageID bigint, AttributeID bigint, ItemTableID bigint, _SubitemID bigint, SortOrder bigint, fields map<string,string>"
REFS = "ItemID bigint, LanguageID bigint, AttributeID bigint, ReferenceID bigint, _SubitemID bigint, SortOrder bigint, fields map<string,string>"


def tables(spark):
    """Item 1 is hot: 30 top rows, one of them with 200 nested rows; item 2 is small."""
    rows = [(1, 2, 191, 1000 + i, 1, i, {"v": str(i)}) for i in range(30)]
    rows += [(1, 2, 192, 5000 + i, 1000, i, {"v": f"n{i}"}) for i in range(200)]
    rows += [(1, 2, 193, 9000 + i, 5003, i, {"v": f"d{i}"}) for i in range(40)]
    rows += [(2, 2, 191, 2000, 2, 0, {"v": "x"}), (2, 2, 192, 2001, 2000, 0, {"v": "y"})]
    refs = [(1, 2, 30, 100 + i, 1, i, {"t": str(i)}) for i in range(75)]
    refs += [(1, 2, 31, 700 + i, 1000, i, {"t": str(i)}) for i in range(60)]
    refs += [(2, 2, 30, 1, 2, 0, {"t": "z"})]
    return spark.createDataFrame(rows, ROWS), spark.createDataFrame(refs, REFS)


def walk(rows):
    """All ids held by nested-table rows, with references."""
    tables_seen, refs_seen = [], []
    for r in rows:
        tables_seen.append(r["ItemTableID"])
        for found in (r.get("Reference") or {}).values():
            refs_seen += [x["ReferenceID"] for x in found]
        if "Subtable" in r:
            for found in (r["Subtable"] or {}).values():
                t, x = walk([f.asDict() for f in found])
                tables_seen += t
                refs_seen += x
    return tables_seen, refs_seen


def test_hot_owner_is_split_and_whole(spark):
    df = spark.createDataFrame([(1, i) for i in range(1000)] + [(2, i) for i in range(10)], "k bigint, v bigint")
    out = sorted(gather(df, ["k"], F.col("v"), ["v"], limit=100).collect(), key=lambda r: r["part"])
    # The parts in turn are the rows in order.
    assert [v for r in out if r["k"] == 1 for v in r["rows"]] == list(range(1000))
    assert [(r["part"], len(r["rows"])) for r in out if r["k"] == 1] == [(i, 100) for i in range(10)]
    assert [(r["part"], r["rows"]) for r in out if r["k"] == 2] == [(0, list(range(10)))]


def test_small_owners_are_one_row(spark):
    df = spark.createDataFrame([(i % 5, i) for i in range(50)], "k bigint, v bigint")
    out = gather(df, ["k"], F.col("v"), ["v"]).collect()
    assert sorted((r["k"], r["part"]) for r in out) == [(i, 0) for i in range(5)]


def test_nested_levels_keep_every_row(spark):
    rows, refs = tables(spark)
    for limit in (25, 50_000):
        top = [r.asDict() for r in with_nested_rows(rows, refs, limit=limit).collect()]
        held, held_refs = walk(top)
        assert set(held) == {r["ItemTableID"] for r in rows.collect()}
        assert all(r["weight"] <= 4 * limit for r in top)
        assert sorted(held_refs) == sorted(r["ReferenceID"] for r in refs.where("_SubitemID <> ItemID").collect())
        if limit == 50_000:
            assert len(held) == rows.count() and {r["part"] for r in top} == {0}


def test_documents_continue_in_parts(spark):
    rows, refs = tables(spark)
    items = spark.createDataFrame(
        [(1, 2, {"Label": "one", "gone": None}), (2, 2, {"Label": "two"})],
        "ID bigint, LanguageID bigint, fields map<string,string>",
    )
    docs = [r.asDict() for r in build_documents(items, refs, rows, limit=40).collect()]
    assert [d["fields"] for d in docs if d["part"] == 0 and d["ID"] == 1] == [{"Label": "one"}]
    assert len([d for d in docs if d["ID"] == 1]) > 1 and len([d for d in docs if d["ID"] == 2]) == 1
    top = [x["ReferenceID"] for d in docs for found in (d["Reference"] or {}).values() for x in found]
    assert sorted(top) == sorted(r["ReferenceID"] for r in refs.where("_SubitemID = ItemID").collect())
    held, below = walk([x.asDict() for d in docs for found in (d["Subtable"] or {}).values() for x in found])
    assert set(held) == {r["ItemTableID"] for r in rows.collect()}
    assert sorted(below) == sorted(r["ReferenceID"] for r in refs.where("_SubitemID <> ItemID").collect())


def test_documents_skip_unknown_items(spark):
    rows, refs = tables(spark)
    items = spark.createDataFrame([(2, 2, {"Label": "two"})], "ID bigint, LanguageID bigint, fields map<string,string>")
    docs = build_documents(items, refs, rows).collect()
    assert [d["ID"] for d in docs] == [2]


def test_any_depth_is_followed_and_circles_end(spark):
    chain = [(1, 2, 190 + i, 100 + i, 99 + i if i else 1, 0, {"v": str(i)}) for i in range(7)]
    circle = [(1, 2, 191, 500, 501, 0, {"v": "a"}), (1, 2, 191, 501, 500, 0, {"v": "b"}), (1, 2, 191, 600, 600, 0, {"v": "c"})]
    again = [(1, 2, 199, 100, 106, 0, {"v": "back to the top"})]
    rows = spark.createDataFrame(chain + circle + again, ROWS)
    top = with_nested_rows(rows).collect()
    assert len(top) == 1
    seen, row = [], top[0]
    while row is not None:
        seen.append(row["ItemTableID"])
        below = row["Subtable"] if "Subtable" in row else None
        row = next(iter(below.values()))[0] if below else None
    assert seen[:7] == [100 + i for i in range(7)]
    assert with_nested_rows(rows.limit(0)).collect() == []


def test_hot_owner_with_small_sort_values_is_many_tasks(spark):
    df = spark.range(30_000).select(
        F.lit(7).cast("bigint").alias("k"), (F.col("id") % 3).alias("AttributeID"), (F.col("id") % 4).alias("SortOrder"), "id"
    )
    placed = in_parts(df, ["k"], ["AttributeID", "SortOrder", "id"], limit=500, hot_rows=3_000)
    per_task = placed.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert max(r["count"] for r in per_task) <= 3_000
    out = gather(
        df, ["k"], F.struct("AttributeID", "SortOrder", "id"), ["AttributeID", "SortOrder", "id"], limit=500, hot_rows=3_000
    ).orderBy("part").collect()
    assert [len(r["rows"]) for r in out] == [500] * 60
    held = [(x["AttributeID"], x["SortOrder"], x["id"]) for r in out for x in r["rows"]]
    assert held == sorted((i % 3, i % 4, i) for i in range(30_000))


def test_hot_owners_of_nested_rows_give_the_same(spark):
    """Item 1 counts as hot: it goes level by level, in chunks, beside item 2, which is built in one go."""
    rows, refs = tables(spark)
    plain = {r["ItemTableID"]: r for r in with_nested_rows(rows, refs, limit=50_000).collect()}
    split = {r["ItemTableID"]: r for r in with_nested_rows(rows, refs, limit=50_000, hot_rows=40).collect()}
    assert split == plain


def test_nesting_brings_rows_to_their_owner_once(spark):
    rows, refs = tables(spark)
    plan = with_nested_rows(rows, refs)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and all("hashpartitioning(ItemID" in line and "REPARTITION" in line for line in exchanges)


def test_depths_found_at_the_owner_equal_those_found_level_by_level(spark):
    """Repeated ids, circles, rows below nothing and nulls, with owners in several batches."""
    mix = [(k % 7, 1 + k % 2, 191, k * 13 % 23, (k * 7 % 29) if k % 5 else k % 7, 0, None) for k in range(400)]
    chain = [(50, 2, 191, 100 + i, 99 + i if i else 50, 0, None) for i in range(60)] * 2
    odd = [(None, 2, 191, 1, 1, 0, None), (50, None, 191, 1, 50, 0, None), (50, 2, 191, None, 50, 0, None), (50, 2, 191, 5, None, 0, None)]
    rows = spark.createDataFrame(mix + chain + odd, ROWS)
    expected = set()
    for i, level in enumerate(by_level(spark.createDataFrame(mix + chain[:12] + odd[:1], ROWS))):
        expected |= {(*r, i) for r in level.collect()}
    found = [tuple(r) for r in places.by_owner(rows).collect()]
    assert len(found) == len(set(found))
    assert {r for r in found if r[0] != 50 or r[4] < 12} == expected
    assert sorted(r[2:] for r in found if r[0] == 50) == [(100 + i, 99 + i if i else 50, i) for i in range(60)]


def test_owners_are_not_cut_when_depths_are_found(monkeypatch):
    """Batches end inside owners; an owner longer than what is looked at in one go stays whole."""
    monkeypatch.setattr(places, "PLACES", 4)
    rows = [(o, 2, 10 + i, 9 + i if i else o, i == 0) for o, n in ((1, 3), (2, 17), (3, 1), (4, 5)) for i in range(n)]
    names = ["ItemID", "LanguageID", "ItemTableID", "_SubitemID", "top"]
    table = pa.table({n: pa.array(c) for n, c in zip(names, zip(*rows))})
    out = pa.Table.from_batches(places._with_depths(iter(table.to_batches(max_chunksize=2)))).to_pylist()
    assert [(r["ItemID"], r["ItemTableID"], r["depth"]) for r in out] == [(o, 10 + i, i) for o, n in ((1, 3), (2, 17), (3, 1), (4, 5)) for i in range(n)]


def test_positions_are_looked_at_only_where_parts_are_cut(spark):
    rows, refs = tables(spark)
    items = spark.createDataFrame([(1, 2, {"Label": "one"})], "ID bigint, LanguageID bigint, fields map<string,string>")
    plans = [build_documents(items, refs, rows, limit=n)._jdf.queryExecution().optimizedPlan().toString() for n in (40, 10_000)]
    assert ["Window" in p for p in plans] == [True, False]
    assert places.by_owner(rows).count() == rows.count()


def test_documents_travel_once_and_are_not_written_on_the_way(spark, monkeypatch):
    """Rows and references are shuffled to their item and stay; finished trees don't travel, whatever the languages."""
    rows, refs = tables(spark)
    written, cut = [], assemble.cut_lineage
    monkeypatch.setattr(assemble, "cut_lineage", lambda df: written.append(df) or cut(df))
    items = spark.createDataFrame([(1, {"Label": "one"}), (2, {"Label": "two"}), (2, {"Label": "twice"}), (3, None), (None, {})],
                                  "ID bigint, fields map<string,string>")
    one, many = F.lit(2).cast("bigint"), F.when(F.col("ID") < 9, 2).cast("bigint")
    found = []
    for language in (one, many):
        docs = build_documents(items.withColumn("LanguageID", language), refs, rows)
        found.append(sorted((str(r) for r in docs.collect() if r.ID), key=str))
        lines = [x for x in docs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines() if "Exchange " in x]
        kept = [x for x in lines if "REPARTITION_BY_NUM" in x]
        assert kept and all("hashpartitioning(ItemID" in x for x in kept)
        # The items come to the trees.
        assert len(lines) == len(kept) + 1
    assert found[0] == found[1] and len(found[0]) == 4
    assert not [df for df in written if "fields" in df.columns]


def test_rows_cut_by_key_are_met_without_a_shuffle(spark):
    configure(spark)
    rows = spark.range(100).select((F.col("id") % 10).alias("ItemID"), F.col("id").alias("v"))
    stored = cut_by_key(rows, ["ItemID"], 4)
    joined = rows.repartition(4, "ItemID").join(stored.withColumnRenamed("v", "w").hint("shuffle_hash"), "ItemID")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 1000 and sorted(map(tuple, stored.collect())) == sorted(map(tuple, rows.collect()))
    assert plan.count("Exchange ") == 1 and "REPARTITION_BY_NUM" in plan
    assert not [t.name for t in spark.catalog.listTables() if "cut" in t.name]


def test_items_hot_in_all_their_languages_give_the_same(spark):
    """No language of item 1 has 40 rows, all of them have 60: it goes level by level, and nothing else changes."""
    rows = [(i, n, 191, 100 * n + k, i, k, {"v": str(k)}) for i in (1, 2) for n in range(1, 4) for k in range(1 + 4 * (i == 1))]
    rows += [(1, n, 192, 1000 * n + k, 100 * n + k % 5, k, {"v": str(k)}) for n in range(1, 4) for k in range(15)]
    rows = spark.createDataFrame(rows, ROWS)
    plain = {(r["ItemID"], r["ItemTableID"]): r for r in with_nested_rows(rows).collect()}
    split = {(r["ItemID"], r["ItemTableID"]): r for r in with_nested_rows(rows, hot_rows=40).collect()}
    assert split == plain and len(plain) == 18 and sum(r["weight"] for r in plain.values()) == rows.count()


def test_sorted_rows_are_grouped_as_they_come(spark):
    """At their item, rows of one part are sorted once: no grouping holds groups by hash or sorts for itself."""
    configure(spark)
    rows, refs = tables(spark)
    df = with_nested_rows(rows, refs)
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "ObjectHashAggregate" not in plan
    # A sort a grouping (references on three levels, rows on two) and one for the rows of each level, which the joins share.
    assert plan.count("- Sort [") <= 8
    shuffled = rows.unionByName(rows.where("ItemID < 0")).orderBy(F.rand(7))
    assert {r["ItemTableID"]: r for r in with_nested_rows(shuffled, refs).collect()} == {r["ItemTableID"]: r for r in df.collect()}
