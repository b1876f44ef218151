"""Items with what hangs off them: references, nested tables, base items, parents and values."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.maps import field_value
from tidemark.operators import catalog
from tidemark.operators.gather import PART_ROWS, gather_by_attribute
from tidemark.operators.ordered import HOT_ROWS, bucket_counts, hot_keys
from tidemark.operators.places import ITEM, OWNER, by_owner
from tidemark.operators.sizes import measured
from tidemark.session import cut_by_key, cut_lineage

HELD = ("Reference", "Subtable")
# Rows of one task where they are dealt by item.
SHARE_ROWS = 1 << 19


def children_of_items(
    items: DataFrame,
    rows: DataFrame,
    assigned: DataFrame | None = None,
    columns: tuple[str, ...] = ("ClassMapping",),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Reference or nested-table rows that hang directly below the items, limited to attributes assigned to them.

    Rows inside other rows (_SubitemID other than the item) are no children of the item. With an ``item_type`` in the
    items, the owner's type in the rows (SourceType, ItemType) must be it. ``assigned`` holds (``columns``, AttributeID):
    few class lists times few attributes. ``keep`` names item columns to carry along.
    """
    owners = items.select(
        F.col("ID").alias("ItemID"), "LanguageID", *[F.col(c).alias(f"__i_{c}") for c in {*columns, *keep}],
        *[F.col("item_type").alias("__type")] * ("item_type" in items.columns),
    )
    if "_SubitemID" in rows.columns:
        rows = rows.where(F.col("_SubitemID") == F.col("ItemID"))
    joined = rows.join(owners, OWNER)
    kind = next((c for c in ("SourceType", "ItemType") if c in rows.columns), None)
    if kind and "item_type" in items.columns:
        joined = joined.where(F.col(kind) == F.col("__type"))
    if assigned is not None:
        given = assigned.select(
            *[F.col(c).alias(f"__l_{c}") for c in columns], F.col("AttributeID").alias("__attribute")
        )
        same = [F.col(f"__i_{c}").eqNullSafe(F.col(f"__l_{c}")) for c in columns]
        joined = joined.join(measured(given), [*same, F.col("AttributeID") == F.col("__attribute")], "left_semi")
    return joined.select(*rows.columns, *[F.col(f"__i_{c}").alias(c) for c in keep])


def with_class_values(rows: DataFrame, by_class: DataFrame) -> DataFrame:
    """Rows whose ``attrs`` hold the attributes of the row's own ClassID and no others; class 0 has none.

    ``by_class``: ClassID, ``class_ids``, one row per class.
    """
    known = measured(by_class.where(F.col("ClassID") != 0).select(F.col("ClassID").alias("__class"), "class_ids"))
    joined = rows.join(known, F.col("ClassID") == F.col("__class"), "left")
    kept = F.map_filter("attrs", lambda k, _: F.coalesce(F.array_contains("class_ids", k), F.lit(False)))
    return joined.withColumn("attrs", kept).select(*rows.columns)


def assembled_items(
    items: DataFrame,
    class_attributes: DataFrame,
    attributes: DataFrame,
    references: DataFrame,
    subtables: DataFrame,
    plugin_ids: list[int] | None = None,
    columns: tuple[str, ...] = ("ClassMapping",),
    limit: int = PART_ROWS,
) -> DataFrame:
    """Items as a reader gets them: their assigned values, references and nested rows, with all that hangs below these.

    ``items``: ID, LanguageID, item_type, class list ``columns``, attrs; ``references`` and ``subtables``: owner, type,
    ClassID, AttributeID, SortOrder, ExternalKey, _SubitemID, attrs and their keys. Item values are those of plain
    attributes that the class lists or plugins assign; values inside a reference or row, at any depth, are those of its
    own class. The result has attribute_ids, attrs, ``part``, Reference and Subtable (attribute → rows, which hold
    Reference and Subtable of their own); an item with more than ``limit`` rows below it comes in parts, of which the
    first has the values.
    """
    by_class = cut_lineage(catalog.assigned_by_class(class_attributes, attributes))
    effective = catalog.effective_attributes(items, class_attributes, attributes, plugin_ids, columns)
    lists = measured(cut_lineage(effective.select(*[F.col(c).alias(f"__l_{c}") for c in columns], "attribute_ids")))
    same = [F.col(c).eqNullSafe(F.col(f"__l_{c}")) for c in columns]
    own = items.join(lists, same, "left").select(
        *items.columns, F.coalesce("attribute_ids", F.array().cast("array<bigint>")).alias("attribute_ids")
    )
    own = own.withColumn("attrs", F.map_filter("attrs", lambda k, _: F.array_contains("attribute_ids", k)))

    def of_kind(kind: int) -> DataFrame:
        return cut_lineage(catalog.assigned_of_kind(items, class_attributes, attributes, kind, plugin_ids, columns))

    def below(rows: DataFrame) -> DataFrame:
        """Rows of these items' type, at any depth, with the values of their own class."""
        kind = next((c for c in ("SourceType", "ItemType") if c in rows.columns), None)
        if kind and "item_type" in items.columns:
            owners = items.select(F.col("ID").alias("ItemID"), "LanguageID", F.col("item_type").alias(kind))
            rows = rows.join(owners, [*OWNER, kind], "left_semi")
        return with_class_values(rows, by_class)

    told = ["ExternalKey", "ClassID"]
    of_table = of_kind(fixed.KIND_SUBTABLE)
    # Nested rows are read on, and built, for the owners that show a top row; of other owners none would be kept.
    place = [c for c in ("ItemType", "SourceType", *OWNER, "AttributeID", "_SubitemID") if c in subtables.columns]
    shown = cut_lineage(children_of_items(items, subtables.select(*place), of_table, columns).select(*place[:-2]).distinct())

    def of_shown(rows: DataFrame) -> DataFrame:
        typed = "item_type" in items.columns
        mine, theirs = (next((c for c in ("SourceType", "ItemType") if c in df.columns), None) for df in (shown, rows))
        kind = [F.col(mine).alias(theirs)] if typed and mine and theirs else []
        owners = shown.select(*OWNER, *kind).distinct()
        return rows.join(measured(owners), owners.columns, "left_semi")

    refs = below(references)
    rows = with_class_values(of_shown(subtables), by_class)
    inside = of_shown(refs.where(F.col("_SubitemID") != F.col("ItemID")))
    targets = [*told, "TargetID", "TargetType", "attrs"]
    top = with_nested_rows(rows, inside, limit, (*told, "attrs"), targets)
    own_refs = gather_by_attribute(
        children_of_items(items, refs, of_kind(fixed.KIND_REFERENCE), columns), OWNER,
        F.struct("SortOrder", "ReferenceID", *targets), ["SortOrder", "ReferenceID"], "Reference", limit,
    ).drop("Reference_weight")
    own_rows = gather_by_attribute(
        children_of_items(items, top, of_table, columns), OWNER,
        F.struct("SortOrder", "ItemTableID", "part", *told, "attrs", *HELD), ["SortOrder", "ItemTableID", "part"], "Subtable",
        limit, F.col("weight"), hot=hot_keys(rows.where(F.col("_SubitemID") == F.col("ItemID")).select(*OWNER), OWNER),
    ).drop("Subtable_weight")
    children = own_refs.join(own_rows, [*OWNER, "part"], "full").withColumnRenamed("ItemID", "ID")
    whole = own.join(children, ["ID", "LanguageID"], "left").withColumn("part", F.coalesce("part", F.lit(0)))
    nothing = F.map_filter("attrs", lambda k, v: F.lit(False))
    return whole.withColumn("attrs", F.when(F.col("part") == 0, F.col("attrs")).otherwise(nothing)).select(
        *own.columns, "part", *HELD
    )


def held_value(rows: Column, attribute_id: int | Column, part: str = "value") -> Column:
    """The values of one attribute inside assembled references or rows, in their order (null where absent)."""
    return F.transform(rows, lambda r: r["attrs"][attribute_id][part])


def held_value_by_key(rows: Column, external_key: str, keys: Column, part: str = "value") -> Column:
    """The same by the attribute's external key; ``keys`` maps external keys to ids."""
    return held_value(rows, keys[external_key], part)


def by_level(rows: DataFrame) -> list[DataFrame]:
    """Places of nested-table rows (``OWNER``, ItemTableID, _SubitemID) level by level: top rows, the rows below them, and
    so on to the depth the data has.

    A place is taken when it is first reached, so rows that go round in a circle are taken once or, as they hang below no
    top row, not at all. Only the ids are looked at; what is taken and what is left is written in one pass a level.
    """
    places = [*OWNER, "ItemTableID", "_SubitemID"]
    edges = rows.select(*places).distinct()
    top = F.col("_SubitemID") == F.col("ItemID")
    marked = cut_lineage(edges.where(top.isNotNull()).withColumn("__hit", top))
    levels = []
    while True:
        hit = marked.where(F.col("__hit")).select(*places)
        if levels and hit.isEmpty():
            return levels
        levels.append(hit)
        parents = hit.select(*OWNER, F.col("ItemTableID").alias("_SubitemID")).distinct().withColumn("__now", F.lit(True))
        rest = marked.where(~F.col("__hit")).select(*places)
        joined = rest.join(parents, [*OWNER, "_SubitemID"], "left")
        marked = cut_lineage(joined.select(*places, F.coalesce("__now", F.lit(False)).alias("__hit")))


def with_nested_rows(
    rows: DataFrame,
    references: DataFrame | None = None,
    limit: int = PART_ROWS,
    payload: Sequence[str] = ("fields",),
    reference_payload: Sequence[str] = ("fields",),
    hot_rows: int = HOT_ROWS,
    single: bool | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Top rows of nested tables, each with all the rows and references below it, however deep.

    ``rows``: ItemID, LanguageID, AttributeID, ItemTableID, _SubitemID, SortOrder and the ``payload``. A row hangs below
    the row whose ItemTableID is its _SubitemID, a top row below the item itself. The result adds Reference and Subtable
    (attribute → rows), ``weight`` (rows held) and ``part``: a row with more than ``limit`` rows and references below it
    comes in several parts, which repeat its own columns and hold the rows below in turn.

    Depths are found on the bare ids and stored by item. Then every row travels once, to its item, where it meets its
    depth, and levels are attached there from the deepest up, by joins and groupings on the owner and more. Items of more
    than ``hot_rows`` rows are taken apart from the others, level by level, so that none of them is gathered in one task.
    Where no owner has more than ``limit`` rows there is but one part and positions aren't looked at; ``single`` says so
    where the caller has counted, and ``counts`` are the ``item_counts`` of these rows, or of more.
    """
    base = rows.select(*OWNER, "AttributeID", "ItemTableID", "_SubitemID", "SortOrder", *payload)
    nested, owners = None, base.select(*OWNER)
    if references is not None:
        nested = references.where(F.col("_SubitemID") != F.col("ItemID")).select(
            *OWNER, F.col("_SubitemID").alias("ItemTableID"), "AttributeID", "ReferenceID", "SortOrder", *reference_payload
        )
        owners = owners.unionByName(nested.select(*OWNER))
    counts = item_counts(owners) if counts is None else counts
    hot = hot_keys(owners, ITEM, hot_rows, counts)
    few = None if hot.isEmpty() else measured(hot)
    same = [F.col(k).eqNullSafe(F.col(f"__h_{k}")) for k in ITEM]
    part = lambda df, how: None if df is None or few is None else df.join(few, same, how)
    many, many_nested, levels = part(base, "left_semi"), part(nested, "left_semi"), []
    if few is None:
        single = is_whole(owners, limit, counts) if single is None else single
    else:
        base, nested, single = part(base, "left_anti"), part(nested, "left_anti"), False
        levels = by_level(many)
    shares = item_shares(counts)
    depth = cut_by_key(by_owner(base, shares), ITEM, shares)
    deepest = max(depth.agg(F.max("depth")).first()[0] or 0, len(levels) - 1)
    names = (tuple(payload), tuple(reference_payload))
    built = _built(*_levels_at_item(base, nested, depth, shares), deepest, limit, *names, hot_rows, False, single)
    if few is None:
        return built
    return built.unionByName(_built(*_levels_stored(many, many_nested, levels), deepest, limit, *names, hot_rows, None))


def is_whole(owners: DataFrame, limit: int, counts: DataFrame | None = None) -> bool:
    """No owner has more than ``limit`` rows. Small limits are passed anyway, so nothing is counted for them."""
    if limit < PART_ROWS:
        return False
    items = hot_keys(owners, ITEM, limit, counts)
    return items.isEmpty() or hot_keys(owners.join(measured(items), F.col("ItemID").eqNullSafe(F.col("__h_ItemID")), "left_semi"), OWNER, limit).isEmpty()


def item_counts(owners: DataFrame) -> DataFrame:
    """Rows by bucket of their item, in whatever language."""
    return bucket_counts(owners, ITEM)


def item_shares(counts: DataFrame) -> int:
    """Tasks that rows are dealt to by their item: about ``SHARE_ROWS`` rows each."""
    rows = counts.agg(F.sum("count")).first()[0] or 0
    return max(counts.sparkSession.sparkContext.defaultParallelism, -(-rows // SHARE_ROWS))


def to_items(df: DataFrame, shares: int) -> DataFrame:
    """Rows brought to their item. All its languages lie together: where a table has but one, its joins are on the item alone."""
    return df.repartition(shares, *ITEM)


def _levels_at_item(base: DataFrame, nested: DataFrame | None, depth: DataFrame, shares: int):
    """Functions of a depth, for the rows and the references on it. Rows are brought to their item by one shuffle, which all
    depths read; ``depth`` lies there already, and those of one depth are held in memory while rows pass."""

    def at_item(df: DataFrame, key: list[str], places: Callable[[DataFrame], DataFrame]):
        placed = to_items(df, shares)
        return lambda i: placed.join(places(depth.where(F.col("depth") == i)).hint("shuffle_hash"), key)

    key = [*OWNER, "ItemTableID"]
    rows = at_item(base, [*key, "_SubitemID"], lambda df: df.drop("depth"))
    return rows, None if nested is None else at_item(nested, key, lambda df: df.select(*key).distinct())


def _levels_stored(base: DataFrame, nested: DataFrame | None, levels: list[DataFrame]):
    """The same for hot owners, whose rows are written with their depth."""
    key = [*OWNER, "ItemTableID"]
    depth = None
    for i, level in enumerate(levels):
        told = level.withColumn("depth", F.lit(i))
        depth = told if depth is None else depth.unionByName(told)
    depth = cut_lineage(depth)

    def stored(df: DataFrame):
        written = cut_lineage(df)
        return lambda i: written.where(F.col("depth") == i).drop("depth")

    rows = stored(base.join(depth, [*key, "_SubitemID"]))
    return rows, None if nested is None else stored(nested.join(depth.select(*key, "depth").distinct(), key))


def _built(rows_on, references_on, deepest: int, limit: int, payload, reference_payload, hot_rows: int, hot: bool | None,
           single: bool = False) -> DataFrame:
    """Levels attached from the deepest up. ``hot`` False: all of an owner's rows fit a task, so rows were brought to their
    item once and nothing is written on the way. None: hot keys are looked for at each level, and each level is written."""
    key = [*OWNER, "ItemTableID"]
    item = F.struct("SortOrder", "ReferenceID", *reference_payload)
    held = None
    for i in range(deepest, -1, -1):
        grouped = []
        if references_on is not None:
            grouped.append(gather_by_attribute(references_on(i), key, item, ["SortOrder", "ReferenceID"], "Reference", limit,
                                               hot=hot, hot_rows=hot_rows, single=single))
        if held is not None:
            inside = [c for c in HELD if c in held.columns]
            below = held.withColumns({"RowID": F.col("ItemTableID"), "ItemTableID": F.col("_SubitemID")})
            row = F.struct("SortOrder", F.col("RowID").alias("ItemTableID"), "part", *payload, *inside)
            grouped.append(
                gather_by_attribute(below, key, row, ["SortOrder", "RowID", "part"], "Subtable", limit, F.col("weight"),
                                    ["SortOrder", "ItemTableID", "part"], hot, hot_rows, single)
            )
        held = _attach(rows_on(i), grouped, key, single)
        if hot is None:
            held = cut_lineage(held)
    if "Subtable" not in held.columns:
        inside = [c for c in HELD if c in held.columns]
        kind = held.select(F.struct("SortOrder", "ItemTableID", "part", *payload, *inside).alias("s")).schema["s"].dataType
        held = held.withColumn("Subtable", F.lit(None).cast(f"map<string,array<{kind.simpleString()}>>"))
    return held


def met(grouped: list[DataFrame], key: list[str]) -> DataFrame:
    """What is grouped below the same keys, side by side: one row for each part of any.

    Parts of a number meet by a grouping, which leaves rows where they are, as a full join would not."""
    parts = grouped[0]
    for further in grouped[1:]:
        both = parts.unionByName(further, allowMissingColumns=True)
        told = [c for c in both.columns if c not in (*key, "part")]
        parts = both.groupBy(*key, "part").agg(*[F.first(c, ignorenulls=True).alias(c) for c in told])
    return parts


def attached(rows: DataFrame, grouped: list[DataFrame], key: list[str], single: bool = False) -> DataFrame:
    """Rows with what is grouped below them: one row for each part of any, and one for a row that holds nothing.

    ``single``: all parts are 0, so each group meets its row by a join of its own, and nothing is copied to meet others."""
    # The grouped side holds whole subtrees: merge, never broadcast it.
    for g in [x.drop("part") for x in grouped] if single else [met(grouped, key)]:
        rows = rows.join(g.hint("merge"), key, "left")
    return rows.withColumn("part", F.lit(0) if single else F.coalesce("part", F.lit(0)))


def _attach(rows: DataFrame, grouped: list[DataFrame], key: list[str], single: bool) -> DataFrame:
    if not grouped:
        return rows.withColumns({"part": F.lit(0), "weight": F.lit(1).cast("bigint")})
    joined = attached(rows, grouped, key, single)
    weight = F.lit(1).cast("bigint")
    for c in joined.columns:
        if c.endswith("_weight") and c not in rows.columns:
            weight = weight + F.coalesce(c, F.lit(0))
    held = [c for c in HELD if c in joined.columns]
    return joined.select(*rows.columns, "part", weight.alias("weight"), *held)


def with_base_rows(view_items: DataFrame, view_rows: DataFrame, base_rows: DataFrame) -> DataFrame:
    """Nested-table rows of view items, followed by those of the base item each extends.

    Rows keep the view item as owner; ``origin`` says where a row comes from.
    """
    extension = view_items.select(F.col("ID").alias("__view"), "LanguageID", F.col("_ExtensionID").alias("ItemID"))
    own = view_rows.join(
        view_items.select(F.col("ID").alias("ItemID"), "LanguageID"), OWNER, "left_semi"
    ).withColumn("origin", F.lit("view"))
    base = base_rows.join(extension, OWNER).select(
        *[F.col("__view").alias("ItemID") if c == "ItemID" else F.col(c) for c in base_rows.columns],
        F.lit("base").alias("origin"),
    )
    return own.unionByName(base)


def with_parent(items: DataFrame, *fields: str) -> DataFrame:
    """Fields of the parent item in the same language, prefixed with ``parent_``; NULL at the top."""
    parents = items.select(
        F.col("ID").alias("__pid"), F.col("LanguageID").alias("__plang"), *[F.col(f).alias(f"parent_{f}") for f in fields]
    )
    return items.join(
        parents, (F.col("ParentID") == F.col("__pid")) & (F.col("LanguageID") == F.col("__plang")), "left"
    ).drop("__pid", "__plang")


def values_long(items: DataFrame, standard: list[str]) -> DataFrame:
    """Every value as a row (ID, LanguageID, field, Value, FormattedValue): standard fields, then attributes."""
    fixed_fields = [
        F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("Value"),
                 F.col(c).cast("string").alias("FormattedValue"))
        for c in standard
    ]
    attributes = F.transform(
        F.map_entries("attrs"),
        lambda e: F.struct(
            e["key"].cast("string").alias("field"), e["value"]["value"].alias("Value"),
            e["value"]["formatted"].alias("FormattedValue"),
        ),
    )
    return items.select(
        "ID", "LanguageID", F.inline(F.concat(F.array(*fixed_fields), attributes))
    )


def value_of(items: DataFrame, field: str | Column, standard: Column, part: str = "value") -> DataFrame:
    """One field per item, by name or attribute id: (ID, LanguageID, value)."""
    field = F.lit(field) if isinstance(field, str) else field
    return items.select("ID", "LanguageID", field_value(field, F.col("attrs"), standard, part).alias("value"))


def values_by_external_key(items: DataFrame, keys: DataFrame) -> DataFrame:
    """Attribute values under the attribute's external key: (ID, LanguageID, ExternalKey, Value, FormattedValue)."""
    return (
        items.select("ID", "LanguageID", F.explode("attrs").alias("AttributeID", "v"))
        .join(measured(keys), "AttributeID")
        .select(
            "ID", "LanguageID", "ExternalKey", F.col("v.value").alias("Value"),
            F.col("v.formatted").alias("FormattedValue"),
        )
    )


def rows_of_attribute(rows: Column, attribute_id: int | Column) -> Column:
    """Rows of one attribute inside an assembled item."""
    return F.filter(rows, lambda r: r["AttributeID"] == attribute_id)


def rows_of_external_key(rows: Column, external_key: str) -> Column:
    """Rows of an assembled item with their own external key."""
    return F.filter(rows, lambda r: r["ExternalKey"] == external_key)
