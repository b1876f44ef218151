"""Typed values out of message text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.text import _col, comma_list, id_list

__all__ = ["number", "timestamp", "list_of_int", "coerce", "default_of", "date_valid", "numeric_shadow", "date_shadow"]


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "") | (F.lower(c) == "null")


def number(c: Column | str, to: str) -> Column:
    """Empty text, NULL and "null" are 0; any other malformed number fails the job, as a bad write would."""
    c = _col(c)
    return F.when(_blank(c), F.lit(0).cast(to)).otherwise(c.cast(to))


def timestamp(c: Column | str, now: Column | None = None) -> Column:
    """Empty text is no time, text with "now" the write time, a bare date midnight; the zero date is NULL."""
    c = _col(c)
    now = F.current_timestamp() if now is None else now
    full = F.when(c.contains(":"), c).otherwise(F.concat(c, F.lit(" 00:00:00")))
    return (
        F.when(_blank(c), F.lit(None).cast("timestamp"))
        .when(c.contains("now"), now)
        .otherwise(F.try_to_timestamp(full, F.lit("yyyy-MM-dd HH:mm:ss")))
    )


def list_of_int(c: Column | str) -> Column:
    """Space-delimited ids as array<int>."""
    return F.transform(id_list(c), lambda i: i.cast("int"))


def coerce(c: Column | str, kind: str, now: Column | None = None) -> Column:
    """Value of a message field under its header type."""
    target = fixed.HEADER_TYPES.get(kind, "string")
    if target in ("int", "bigint", "float", "double"):
        return number(c, target)
    if target == "timestamp":
        return timestamp(c, now)
    if target == "array<int>":
        return list_of_int(c)
    return _col(c)


def default_of(kind: str) -> Column:
    """Value a column gets when the message leaves it out."""
    target = fixed.HEADER_TYPES.get(kind, "string")
    if target in ("int", "bigint", "float", "double"):
        return F.lit(0).cast(target)
    if target == "timestamp":
        return F.lit(None).cast("timestamp")
    if target == "array<int>":
        return F.array().cast("array<int>")
    return F.lit("")


def date_valid(c: Column | str, fmt: str) -> Column:
    """The text is a real date in the format."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).isNotNull()


def numeric_shadow(c: Column | str) -> Column:
    """Number of a text value, NULL when it is none."""
    return _col(c).try_cast("double")


def _shape(fmt: str) -> str:
    """Pattern of the texts a format can read, so every value is parsed at most once."""
    return "^" + re.sub(r"[yMdHms]", r"\\d", re.escape(fmt).replace(r"\ ", " ").replace(r"\-", "-")) + "$"


def date_shadow(c: Column | str) -> Column:
    """Time of a text value in the first accepted format that fits, NULL when none does."""
    c = F.trim(_col(c))
    iso = r"^\d{4}(-\d{2}(-\d{2}(T\d{2}(:\d{2}(:\d{2}(\.\d{1,9})?)?)?(Z|[+-]\d{2}:?\d{2})?)?)?)?$"
    result = F.when(
        c.rlike(iso),
        F.when(F.length(c) == 4, F.try_to_timestamp(F.concat(c, F.lit("-01-01"))))
        .when(F.length(c) == 7, F.try_to_timestamp(F.concat(c, F.lit("-01"))))
        .otherwise(F.try_to_timestamp(c)),
    ).when(c.rlike(r"^-?\d+$"), F.timestamp_millis(c.try_cast("bigint")))
    for fmt in fixed.DATE_FORMATS:
        result = result.when(c.rlike(_shape(fmt)), F.try_to_timestamp(c, F.lit(fmt)))
    return result


def split_ids(c: Column | str) -> Column:
    """Comma-delimited ids as array<bigint>."""
    return F.transform(comma_list(c), lambda i: i.cast("bigint"))
