"""Search documents: one per item and language, with its references and nested tables inside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.maps import keep_keys, keep_paths, without_nulls
from tidemark.functions.text import big_value, content_excerpt, html_text
from tidemark.operators.assemble import OWNER, attached, is_whole, item_counts, item_shares, to_items, with_nested_rows
from tidemark.operators.gather import PART_ROWS, gather_by_attribute
from tidemark.operators.ordered import hot_keys
from tidemark.session import cut_lineage


def clean(fields: Column | str, html_fields: Sequence[str] = (), big_fields: Column | None = None) -> Column:
    """Fields of a document: no nulls, html fields as text, listed long attributes cut."""
    result = without_nulls(fields)
    if html_fields:
        result = F.transform_values(
            result, lambda k, v: F.when(k.isin(list(html_fields)), html_text(v)).otherwise(v)
        )
    if big_fields is not None:
        listed = F.coalesce(big_fields, F.array().cast("array<string>"))
        result = F.transform_values(
            result, lambda k, v: F.when(F.array_contains(listed, k), big_value(v)).otherwise(v)
        )
    return result


def build_documents(
    items: DataFrame,
    references: DataFrame,
    subtables: DataFrame,
    html_fields: Sequence[str] = (),
    limit: int = PART_ROWS,
    affected: DataFrame | None = None,
) -> DataFrame:
    """Documents (ID, LanguageID, part, fields, Reference, Subtable), of the ``affected`` ids only if these are given.

    ``items``: ID, LanguageID, fields (and big_fields); ``references``: ItemID, LanguageID, AttributeID,
    ReferenceID, _SubitemID, SortOrder, fields; ``subtables`` as in ``with_nested_rows``. An item with more than
    ``limit`` children continues in documents with part > 0 that hold the further children in order. Children of an item
    the store does not hold make no document.
    """
    if affected is not None:
        # Before anything is built: only what hangs below an affected id is read on. The ids are written, so their size is
        # known when the joins are planned, and rows aren't shuffled to meet a list that can be broadcast.
        ids = cut_lineage(affected.select("ID").distinct())
        owners = ids.select(F.col("ID").alias("ItemID"))
        items = items.join(ids, "ID", "left_semi")
        references = references.join(owners, "ItemID", "left_semi")
        subtables = subtables.join(owners, "ItemID", "left_semi")
    big = F.col("big_fields") if "big_fields" in items.columns else None
    docs = items.select("ID", "LanguageID", clean("fields", html_fields, big).alias("fields"))
    refs = references.withColumn("fields", clean("fields", html_fields))
    rows = subtables.withColumn("fields", clean("fields", html_fields))
    # What hangs below an item is counted once for all groupings.
    below = refs.select(*OWNER).unionByName(rows.select(*OWNER))
    counts = item_counts(below)
    single = is_whole(below, limit, counts)
    own = refs.where(F.col("_SubitemID") == F.col("ItemID"))
    own_refs = gather_by_attribute(
        # Brought to their items as the rows are, so what is grouped here meets what is built there.
        to_items(own, item_shares(counts)),
        OWNER,
        F.struct("SortOrder", "ReferenceID", "fields"),
        ["SortOrder", "ReferenceID"],
        "Reference",
        limit,
        hot=False if single else None,
        single=single,
    ).drop("Reference_weight")
    top = with_nested_rows(rows, refs, limit, single=single, counts=counts)
    own_rows = gather_by_attribute(
        top,
        OWNER,
        F.struct("SortOrder", "ItemTableID", "part", "fields", "Reference", "Subtable"),
        ["SortOrder", "ItemTableID", "part"],
        "Subtable",
        limit,
        F.col("weight"),
        hot=False if single else hot_keys(rows.where(F.col("_SubitemID") == F.col("ItemID")).select(*OWNER), OWNER),
        single=single,
    ).drop("Subtable_weight")
    # Trees stay where they were built: the items travel to them.
    children = [df.withColumnRenamed("ItemID", "ID") for df in (own_refs, own_rows)]
    whole = attached(docs, children, ["ID", "LanguageID"], single)
    # The first document of an item has its fields, further ones only the children that continue it.
    fields = F.when(F.col("part") == 0, F.col("fields")).otherwise(F.create_map().cast("map<string,string>"))
    return whole.select("ID", "LanguageID", fields.alias("fields"), "part", "Reference", "Subtable")


def searchable_documents(
    docs: DataFrame, fields: Column, reference_ids: Column, subtable_ids: Column
) -> DataFrame:
    """Searchable copy of the documents: only searchable fields, references and nested tables; nothing empty."""

    def kept(name: str, ids: Column) -> Column:
        found = keep_keys(name, ids)
        return F.when(F.size(found) > 0, found)

    return docs.withColumns(
        {
            "fields": keep_keys("fields", fields),
            "Reference": kept("Reference", reference_ids),
            "Subtable": kept("Subtable", subtable_ids),
        }
    )


def reindex_fields(
    assigned: Sequence[str] | None,
    searchable_references: Sequence[str],
    searchable_subtables: Sequence[str],
    searchable_and_standard: Sequence[str],
) -> tuple[list[str], list[str], list[str]]:
    """Fields, references and nested tables a re-projection copies.

    Assigned ids limit all three; what is neither a reference nor a table is an attribute with both value fields.
    """
    if assigned is None:
        return sorted(searchable_and_standard), sorted(searchable_references), sorted(searchable_subtables)
    refs = sorted(set(searchable_references) & set(assigned))
    tables = sorted(set(searchable_subtables) & set(assigned))
    plain = sorted(set(assigned) - set(refs) - set(tables))
    return [f"{i}:{suffix}" for i in plain for suffix in ("Value", "FormattedValue")], refs, tables


def reproject(
    docs: DataFrame, affected: DataFrame, fields: list[str], references: list[str], subtables: list[str],
    languages: list[int] | None = None,
) -> DataFrame:
    """Searchable documents of the affected ids, as they replace the old ones: of their source only the named fields, and
    all below the named references and nested tables."""
    rows = docs if languages is None else docs.where(F.col("LanguageID").isin(languages))
    hit = rows.join(affected.select("ID").distinct(), "ID", "left_semi").select(*docs.columns)
    paths = [*fields, *[f"Reference.{i}.*" for i in references], *[f"Subtable.{i}.*" for i in subtables]]

    def held(name: str) -> Column:
        found = keep_paths(name, paths, name)
        return F.when(F.size(found) > 0, found)

    return hit.withColumns({"fields": keep_paths("fields", paths), "Reference": held("Reference"), "Subtable": held("Subtable")})


def delete_documents(docs: DataFrame, deleted: DataFrame) -> DataFrame:
    """Documents without those of the deleted ids, in every language; ids without a document are no error."""
    return docs.join(deleted.select("ID").distinct(), "ID", "left_anti").select(*docs.columns)


def with_excerpt(docs: DataFrame, content: str = "_Content") -> DataFrame:
    """File-content documents get a raw excerpt."""
    return docs.withColumn("_ContentRaw", content_excerpt(content))
