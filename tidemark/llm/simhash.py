"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints: bit i is 1 if it is set in more than half of the document's shingle hashes (XXH64, seed 42). Documents
link when their fingerprints differ in at most ``radius`` bits; links are closed into components.

Distinct fingerprints are compared, never documents, so a group of equal ones of any size is one row. By the pigeonhole
rule, two fingerprints within the radius agree in whole on ``blocks - radius`` of ``blocks`` bit fields: every choice of
that many fields is a key, and only fingerprints that share a key meet. A key that too many share is split again by the
same rule on its remaining bits, so no key gathers an unbounded set, and no pair within the radius is lost.

Within a block of fingerprints, the bits are stored as planes: one plane holds one bit of 64 fingerprints per word. A
query adds its difference from each plane to vertical counters with carry-save steps, so one word operation moves 64
distances on; a block is abandoned once every counter is beyond the radius. A block gives each fingerprint one link
towards the least of those it is connected to, never all pairs.

Defined cases: null text is empty; texts without words have fingerprint zero and link like any other; fewer words than a
shingle give one shingle of them all; null ids take part, and a component's id is its least id that is not null (null if
it has none); repeated ids and rows stay rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, whole_text, with_row_key
from tidemark.llm.links import components
from tidemark.session import cut_lineage

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 2
# Bit fields of the pigeonhole rule; all but RADIUS of them make a key.
FIELDS = 4
# Fingerprints of one key that are compared as they are; keys shared by more are split by further bits.
KEY_ROWS = 4096
# Fingerprints of one bit-sliced block.
BLOCK = 1024

_BITS = np.arange(64, dtype=np.uint64)
_ONE = np.uint64(1)
_ALL = ~np.uint64(0)
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_TO_SPACE = bytes.maketrans(bytes(range(9, 14)), b" " * 5)


def shingle_hashes(text: str, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every shingle, repeats included."""
    words = text.encode().translate(_LOWER).translate(_TO_SPACE).split(b" ")
    words = [w for w in words if w]
    if not words:
        return np.zeros(0, np.uint64)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(shingle_words, len(words))
    stops = ends[width - 1 :].tolist()
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The majority bits of the hashes; zero without any."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = np.ascontiguousarray(hashes[at : at + (1 << 15)]).astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.bitwise_or.reduce(np.where(2 * ones > len(hashes), _ONE << _BITS, np.uint64(0))))


def _fingerprints(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = np.array([fingerprint(shingle_hashes(t.as_py(), shingle_words)) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found.view(np.int64))], names=[*batch.schema.names[:-1], "__fp"]
            )

    return run


def fingerprints(docs: DataFrame, id_column: str, text_column: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``__id``, ``__row`` and ``__fp`` (the fingerprint's 64 bits as a long) of every document."""
    rows = docs.select(
        F.col(id_column).alias("__id"), F.monotonically_increasing_id().alias("__row"), whole_text(text_column).alias("__text")
    )
    id_type = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(_fingerprints(shingle_words), f"__id {id_type}, __row long, __fp long")


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes (64, words): bit j of word w of plane i is bit i of value 64 w + j."""
    words = -(-len(values) // 64)
    padded = np.zeros(words * 64, dtype=np.uint64)
    padded[: len(values)] = values
    bits = ((padded[None, :] >> _BITS[:, None]) & _ONE).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def within(queries: np.ndarray, block: np.ndarray, radius: int) -> np.ndarray:
    """Boolean (queries, block): differ in at most ``radius`` bits."""
    sliced = planes(block)
    levels = radius.bit_length()
    shape = (len(queries), sliced.shape[1])
    # Vertical counters hold min(distance, ...) mod 2**levels per lane; a lane that passes the top is beyond for good.
    counters = np.zeros((levels, *shape), dtype=np.uint64)
    beyond = np.zeros(shape, dtype=np.uint64)
    if len(block) % 64:
        beyond[:, -1] = _ALL << np.uint64(len(block) % 64)
    for i in range(64):
        asked = np.where((queries >> _BITS[i]) & _ONE, _ALL, np.uint64(0))
        carry = sliced[i][None, :] ^ asked[:, None]
        for level in range(levels):
            counters[level], carry = counters[level] ^ carry, counters[level] & carry
        beyond |= carry
        if i % 8 == 7:
            if (beyond | _exceeds(counters, radius) == _ALL).all():
                return np.zeros((len(queries), len(block)), dtype=bool)
    near = ~(beyond | _exceeds(counters, radius))
    return np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, : len(block)].astype(bool)


def _exceeds(counters: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is above the radius, compared from the top bit down."""
    above = np.zeros_like(counters[0]) if len(counters) else np.uint64(0)
    equal = ~np.zeros_like(above)
    for level in reversed(range(len(counters))):
        if radius >> level & 1:
            equal &= counters[level]
        else:
            above |= equal & counters[level]
            equal &= ~counters[level]
    return above


def _runs(keys: list[np.ndarray]) -> np.ndarray:
    change = np.zeros(len(keys[0]), dtype=bool)
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.concatenate(([0], np.flatnonzero(change), [len(change)]))


def local_roots(values: np.ndarray, radius: int) -> np.ndarray:
    """The position of the first value that each value is connected to, comparing all of them bit-sliced."""
    n = len(values)
    root = np.arange(n)
    pairs = []
    for a in range(0, n, BLOCK):
        for b in range(a, n, BLOCK):
            x, y = np.nonzero(within(values[a : a + BLOCK], values[b : b + BLOCK], radius))
            keep = x + a < y + b
            pairs.append((x[keep] + a, y[keep] + b))
            # Links found so far are closed at once, so that at most one block's pairs are held.
            root = _close(root, *pairs.pop())
    return root


def _close(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        differ = low != high
        if not differ.any():
            break
        x, y = x[differ], y[differ]
        np.minimum.at(root, high[differ], low[differ])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _compare(radius: int):
    """mapInArrow over rows sorted by key: links of each key's fingerprints towards the first they connect to."""

    def emit(values: np.ndarray) -> pa.RecordBatch | None:
        values = np.unique(values)
        root = local_roots(values, radius)
        moved = root != np.arange(len(values))
        return pa.RecordBatch.from_arrays(
            [pa.array(values[moved].view(np.int64)), pa.array(values[root[moved]].view(np.int64))], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        key = None
        for batch in batches:
            keys = [batch.column(0).to_numpy(), batch.column(1).to_numpy()]
            values = batch.column(2).to_numpy().view(np.uint64)
            cuts = _runs(keys)
            for a, b in zip(cuts[:-1], cuts[1:]):
                own = (keys[0][a], keys[1][a])
                # Whole keys are put together until a block is full: pairs of different keys that lie within the
                # radius are true links as well.
                if own != key and size >= BLOCK:
                    yield emit(np.concatenate(held))
                    held, size = [], 0
                held.append(values[a:b])
                size += b - a
                key = own
        if size:
            yield emit(np.concatenate(held))

    return run


def _keys(fp: Column, low: int, high: int, fields: int, radius: int) -> Column:
    """All keys of the bits from ``low`` to ``high``: (which fields, their bits) packed into two longs."""
    edges = [low + round(i * (high - low) / fields) for i in range(fields + 1)]
    masks = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(fields)]
    out = []
    for number, chosen in enumerate(combinations(range(fields), fields - radius)):
        mask = sum(masks[i] for i in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        out.append(F.struct(F.lit(number).cast("long").alias("k"), fp.bitwiseAND(F.lit(signed)).alias("v")))
    return F.array(*out)


def link_fingerprints(distinct: DataFrame, radius: int = RADIUS, fields: int = FIELDS, key_rows: int = KEY_ROWS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within the radius; column ``__fp`` in."""
    fp = F.col("__fp")
    keyed = distinct.select(F.explode(_keys(fp, 0, 64, fields, radius)).alias("__x"), fp).select("__x.k", "__x.v", "__fp")
    counts = keyed.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = keyed.join(counts, ["k", "v"])
    few = shared.where(F.col("n") <= key_rows).select("k", "v", "__fp")
    # Keys that many share are split by every choice of fields of all 64 bits, twice as fine: rows of such a key meet
    # again under at least one of them, and a finer key is shared by far fewer.
    finer = fields * 2
    many = shared.where(F.col("n") > key_rows).select("__fp").distinct()
    split = many.select(F.explode(_keys(fp, 0, 64, finer, radius)).alias("__x"), fp).select(
        (F.col("__x.k") + F.lit(1 << 20)).alias("k"), "__x.v", "__fp"
    )
    meet = few.unionByName(split).repartition("k", "v").sortWithinPartitions("k", "v")
    return meet.mapInArrow(_compare(radius), "a long, b long")


def near_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    key_rows: int = KEY_ROWS,
) -> DataFrame:
    """One row per document: id, ``__row``, ``fingerprint`` (16 hex digits) and ``component_id``."""
    prints = cut_lineage(fingerprints(docs, id_column, text_column, shingle_words))
    per_print = cut_lineage(prints.groupBy("__fp").agg(F.min("__id").alias("__least")))
    linked = components(link_fingerprints(per_print.select("__fp"), radius, FIELDS, key_rows))
    rooted = per_print.join(linked, per_print["__fp"] == linked["node"], "left").select(
        "__fp", F.coalesce("root", "__fp").alias("__root"), "__least"
    )
    least = rooted.groupBy("__root").agg(F.min("__least").alias("component_id"))
    named = cut_lineage(rooted.join(least, "__root").select(F.col("__fp").alias("__of"), "component_id"))
    return prints.join(named, prints["__fp"] == named["__of"]).select(
        F.col("__id").alias(id_column),
        "__row",
        F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """The rows of ``docs`` that stay, whole: of each component the first by id (then by position)."""
    key = free_name(docs, "__key")
    keyed = with_row_key(docs, id_column, key)
    groups = near_groups(keyed, key, text_column, shingle_words, radius)
    gone = groups.where(F.col(key) != F.col("component_id")).select(key)
    return keyed.join(gone, key, "left_anti").select(*docs.columns)
