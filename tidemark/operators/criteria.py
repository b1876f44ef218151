"""Conjunctive item filters."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import has_token



def _listed(column: Column, values) -> Column:
    """Member of a list, given as values or as text separated by commas (with or without parentheses)."""
    if isinstance(values, str):
        values = [v.strip().strip("'") for v in values.strip().removeprefix("(").removesuffix(")").split(",")]
    return column.isin([F.lit(v) for v in values])


# --- fixed values: comparison words of the filters ------------------------------------------------------
COMPARISONS: dict[str, Callable] = {
    "=": operator.eq,
    "<": operator.lt,
    ">": operator.gt,
    "<=": operator.le,
    ">=": operator.ge,
    "LIKE": lambda column, pattern: column.cast("string").like(str(pattern)),
    "CONTAINS": lambda column, part: column.cast("string").contains(F.lit(part).cast("string")),
    "IN": _listed,
}

# Ids up to this many are looked for in the scan by ``apply``; more are semi joined.
IN_LIST_LIMIT = 1000


@dataclass(frozen=True)
class Criteria:
    """Filters that all must hold. Every method returns a new object, so criteria can be shared and extended."""

    predicates: tuple[Column, ...] = ()
    ids: frozenset[int] | None = None
    id_frame: DataFrame | None = None
    language_id: int | None = None
    language: str | None = None
    _names: tuple[str, ...] = field(default=())

    def _and(self, name: str, predicate: Column) -> Criteria:
        return replace(self, predicates=(*self.predicates, predicate), _names=(*self._names, name))

    def _compare(self, column: str, value, comparison: str, kind: str | None = None) -> Criteria:
        """``comparison`` in any case and spacing; ``kind`` is the type a value is read as for ordering."""
        word = comparison.strip().upper()
        if word not in COMPARISONS:
            raise ValueError(f"comparison {comparison!r} is none of {sorted(COMPARISONS)}")
        if kind and word not in ("LIKE", "CONTAINS", "IN"):
            value = F.lit(value).cast(kind)
        return self._and(column, COMPARISONS[word](F.col(column), value))

    def item_ids(self, ids: Iterable[int] | DataFrame) -> Criteria:
        """Accumulates: ids given in several calls are united. A DataFrame needs a column ID."""
        if isinstance(ids, DataFrame):
            frame = ids.select("ID")
            return replace(self, id_frame=frame if self.id_frame is None else self.id_frame.union(frame))
        return replace(self, ids=frozenset(ids) | (self.ids or frozenset()))

    def workflow_id(self, value: int, comparison: str = "=") -> Criteria:
        return self._compare("WorkflowID", value, comparison)

    def state_id(self, value: int, comparison: str = "=") -> Criteria:
        return self._compare("StateID", value, comparison)

    def class_id(self, value: int) -> Criteria:
        return self._and("ClassMapping", has_token("ClassMapping", value))

    def ancestor(self, value: int) -> Criteria:
        return self._and("_Parents", has_token("_Parents", value))

    def parent_id(self, value: int, comparison: str = "=") -> Criteria:
        return self._compare("ParentID", value, comparison)

    def last_change(self, value: str, comparison: str = "=") -> Criteria:
        return self._compare("LastChange", value, comparison, "timestamp")

    def creation_date(self, value: str, comparison: str = "=") -> Criteria:
        return self._compare("CreationDate", value, comparison, "timestamp")

    def language_short_name(self, value: str) -> Criteria:
        return replace(self._and("LanguageShortName", F.col("LanguageShortName") == value), language=value)

    def language_by_id(self, value: int) -> Criteria:
        return replace(self, language_id=value)

    def label(self, value: str, comparison: str = "=") -> Criteria:
        return self._compare("Label", value, comparison)

    def is_folder(self, value: int) -> Criteria:
        return self._compare("IsFolder", value, "=")

    def external_key(self, value: str, comparison: str = "=") -> Criteria:
        return self._compare("ExternalKey", value, comparison)

    def copy_of(self, value: int) -> Criteria:
        return self._compare("CopyOf", value, "=")

    def checkout_user(self, value: int) -> Criteria:
        return self._compare("CheckoutUser", value, "=")

    def author_id(self, value: int) -> Criteria:
        return self._compare("AuthorID", value, "=")

    def author(self, value: str) -> Criteria:
        return self._compare("Author", value, "=")

    def custom_attribute(self, attribute_id: int, formatted: str) -> Criteria:
        return self._and("attrs", F.col("attrs")[attribute_id]["formatted"] == formatted)

    def user_defined(self, predicate: str) -> Criteria:
        """Any further predicate, as Spark SQL text."""
        return self._and("user", F.expr(predicate))

    def to_column(self, default_language: int | None = None) -> Column:
        """The conjunction. Without a language filter the default language applies (None for record types).

        Listed ids are part of it, however many; ids given as a DataFrame can't be and need ``apply``.
        """
        if self.id_frame is not None:
            raise ValueError("ids given as a DataFrame are joined: use apply")
        parts = list(self.predicates)
        if self.ids is not None:
            parts.insert(0, F.col("ID").isin(sorted(self.ids)))
        if self.language_id is not None:
            parts.append(F.col("LanguageID") == self.language_id)
        elif default_language is not None and self.language is None:
            parts.append(F.col("LanguageID") == default_language)
        return reduce(lambda x, y: x & y, parts) if parts else F.lit(True)

    def apply(self, items: DataFrame, default_language: int | None = None) -> DataFrame:
        """Matching items. Long id sets and id frames are semi joined instead of being inlined."""
        if self.id_frame is None and (self.ids is None or len(self.ids) <= IN_LIST_LIMIT):
            return items.where(self.to_column(default_language))
        wanted = self.id_frame
        if self.ids is not None:
            listed = items.sparkSession.createDataFrame([(i,) for i in sorted(self.ids)], "ID bigint")
            wanted = listed if wanted is None else wanted.union(listed)
        rest = replace(self, ids=None, id_frame=None)
        return items.where(rest.to_column(default_language)).join(wanted, "ID", "left_semi")


def changed_since(
    items: DataFrame,
    column: str,
    since: str | Column,
    criteria: Criteria | None = None,
    default_language: int | None = None,
) -> DataFrame:
    """Items written (``_LastWritten``) or created (``_InsertTime``) after ``since``.

    The change is looked up in the default language; further criteria then select among those ids, in the
    language the criteria name.
    """
    since = F.lit(since).cast("timestamp") if isinstance(since, str) else since
    changed = Criteria().apply(items.where(F.col(column) > since), default_language)
    if criteria is None:
        return changed
    return criteria.apply(items, default_language).join(changed.select("ID"), "ID", "left_semi")
