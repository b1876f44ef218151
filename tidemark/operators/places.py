"""Depths of nested-table rows. The functions that run in tasks travel with the plan."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OWNER = ["ItemID", "LanguageID"]
# All languages of an item are brought together.
ITEM = OWNER[:1]
# Places whose depths are found at a time; an owner's are never cut.
PLACES = 1 << 18


def by_owner(rows: DataFrame, shares: int | None = None) -> DataFrame:
    """Places of nested-table rows with their ``depth``, as ``assemble.by_level`` finds them, where each
    owner's places fit a task.

    The bare ids travel once, to their item (in ``shares`` tasks, if given), and all levels are followed there.
    """
    places = [*OWNER, "ItemTableID", "_SubitemID"]
    known = rows.select(*places, (F.col("_SubitemID") == F.col("ItemID")).alias("top")).dropna(subset=places)
    placed = known.repartition(*[shares] * (shares is not None), *ITEM).sortWithinPartitions(*places)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in known.select(*places).schema)
    return placed.mapInArrow(_with_depths, f"{kinds}, depth int")


def _starts(columns: Sequence[pa.ChunkedArray]) -> np.ndarray:
    """True where a sorted row differs from the one before it."""
    first = np.ones(len(columns[0]), dtype=bool)
    if len(first):
        first[1:] = np.logical_or.reduce([pc.not_equal(c[1:], c[:-1]).to_numpy() for c in columns])
    return first


def _with_depths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over places sorted by owner: as many whole owners at a time as ``PLACES`` holds, one at least."""
    held, number, enough = [], 0, PLACES
    for batch in batches:
        held.append(batch)
        number += batch.num_rows
        if number < enough:
            continue
        table = pa.Table.from_batches(held)
        last = int(np.flatnonzero(_starts(table.columns[: len(OWNER)]))[-1])
        if last:
            yield from _depths(table.slice(0, last))
        rest = table.slice(last)
        held, number, enough = rest.to_batches(), rest.num_rows, max(PLACES, 2 * rest.num_rows)
    if held:
        yield from _depths(pa.Table.from_batches(held))


def _depths(table: pa.Table) -> list[pa.RecordBatch]:
    """Different places that hang below a top row, with the level on which they are first reached."""
    table = table.filter(pa.array(_starts(table.columns[:-1]))).combine_chunks()
    owner = np.cumsum(_starts(table.columns[: len(OWNER)]))
    ids = pa.concat_arrays([c for at in (-3, -2) for c in table.columns[at].chunks])
    codes = ids.dictionary_encode().indices.to_numpy().astype(np.int64) if len(ids) else np.zeros(0, dtype=np.int64)
    own, below = (owner * (len(ids) + 1) + part for part in np.split(codes, 2))
    order = np.argsort(below, kind="stable")
    parents = below[order]
    depth = np.full(len(owner), -1, dtype=np.int32)
    reached, level = np.flatnonzero(table.columns[-1].to_numpy()), 0
    while len(reached):
        depth[reached] = level
        held = np.unique(own[reached])
        begin, end = np.searchsorted(parents, held, "left"), np.searchsorted(parents, held, "right")
        sizes = end - begin
        found = order[np.arange(sizes.sum()) + np.repeat(begin - np.cumsum(sizes) + sizes, sizes)]
        reached, level = found[depth[found] < 0], level + 1
    told = table.drop_columns("top").append_column("depth", pa.array(depth))
    return told.filter(pa.array(depth >= 0)).to_batches()
