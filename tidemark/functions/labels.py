"""Labels, flags and units of the change feed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.text import _col


def operation_label(action: Column | str, priority: Column | str, kind: Column | str) -> Column:
    """Initial / Update / Delete / Create followed by the kind of change."""
    action = _col(action)
    initial = _col(priority).isin(
        fixed.PRIORITY_ITEM, fixed.PRIORITY_CONFIGURATION_MAPPING, fixed.PRIORITY_OPERATION
    )
    verb = (
        F.when(initial, "Initial")
        .when(action == fixed.ACTION_UPDATE, "Update")
        .when(action == fixed.ACTION_DELETE, "Delete")
        .when(action == fixed.ACTION_CREATE, "Create")
        .otherwise("")
    )
    return F.concat(verb, _col(kind))


def effective_priority(priority: Column | str, kind: Column | str) -> Column:
    """Log priority 0 marks the initial load and becomes the priority of the kind; others are sent as they are."""
    kind = _col(kind)
    initial = (
        F.when(kind.isin(fixed.TYPE_CONFIGURATION, fixed.TYPE_MAPPING), fixed.PRIORITY_CONFIGURATION_MAPPING)
        .when(kind == fixed.TYPE_FILE_CONTENT, fixed.PRIORITY_FILE_CONTENT)
        .otherwise(fixed.PRIORITY_ITEM)
    )
    return F.when(_col(priority) == fixed.LOG_PRIORITY_INITIAL, initial).otherwise(_col(priority)).cast("int")


def export_type(priority: Column | str) -> Column:
    """0 for the initial load, 1 for a delta."""
    return F.when(_col(priority) == fixed.LOG_PRIORITY_INITIAL, fixed.EXPORT_TYPE_INITIAL).otherwise(
        fixed.EXPORT_TYPE_DELTA
    )


def is_taken(status: Column | str, consumer: int) -> Column:
    """The consumer's bit is set."""
    return _col(status).bitwiseAND(F.lit(consumer)) != 0


def byte_size(c: Column | str) -> Column:
    """Whole units of 1024, biggest unit that still gives at least 1."""
    c = _col(c).cast("bigint")
    text = F.when(c < 1024, F.concat_ws(" ", c.cast("string"), F.lit(fixed.BYTE_UNITS[0])))
    for power, unit in enumerate(fixed.BYTE_UNITS[1:], start=1):
        size = F.shiftright(c, 10 * power).cast("string")
        if power + 1 < len(fixed.BYTE_UNITS):
            text = text.when(c < F.lit(1 << (10 * (power + 1))), F.concat_ws(" ", size, F.lit(unit)))
        else:
            text = text.otherwise(F.concat_ws(" ", size, F.lit(unit)))
    return text


def duration(ms: Column | str) -> Column:
    """Milliseconds as hours, minutes, seconds and milliseconds."""
    ms = _col(ms).cast("bigint")
    sec = F.floor(ms / 1000)
    return F.format_string(
        "%dh %dm %ds %dms", F.floor(sec / 3600), F.floor(sec / 60) % 60, sec % 60, ms % 1000
    )
