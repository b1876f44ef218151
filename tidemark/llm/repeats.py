"""Removal of long repeated passages, by suffix sorting and threshold-bounded interval expansion.

A byte goes if some string of ``min_bytes`` bytes that covers it also starts earlier in the corpus: in a row with a
smaller key, or in the same row further ahead. Strings never cross rows and are judged on the input.

1. Whole copies of a text are settled first, by digest: each but the first goes entirely.
2. Every window of ``min_bytes`` bytes picks one longer substring of itself, at the place of the least hash among its
   ``GRAM``-byte substrings modulo the number of places, and is named by that substring's hash. Equal windows have equal
   names, whatever stands around them. Consecutive windows that pick the same place are a region; only name, place and
   digest of a region travel, and regions whose name occurs once are dropped after a map-side combined count. Names are
   substrings of half a window, so texts hardly share one unless they share a passage.
3. Regions alike in every byte need no comparison: all but the first one go.
4. The different regions of one name are put together with those of other names into strings of bounded size. Their
   suffixes are sorted and the Burrows-Wheeler transform taken. Breadth-first backward extension over its intervals
   finds the common prefixes in the order of their length: level by level every interval of strings of length l is
   extended to the left, and a boundary between neighbouring suffixes that is met for the first time has a common prefix
   of just that length. It stops at ``min_bytes``: suffixes without a boundary between them share their first
   ``min_bytes`` bytes. The earliest of each such set stays.
5. A name with more than ``HOT_REGIONS`` different regions is split: its windows are dealt out by their own 128-bit
   digest and the first of each found by a map-side combined minimum. That is exact too, and no task gathers the name.

Defined cases: null text is empty; texts shorter than ``min_bytes`` stay whole; repeated rows and ids and null ids are
ordered by id (nulls last), then by content, and treated as rows of their own; any length is read, in pieces that overlap
by a window; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, free_name, whole_text, with_row_key
from tidemark.session import cut_lineage

MIN_BYTES = 100
GRAM = 8
# Bytes of text hashed at a time, and of regions sorted at a time.
TEXT_PIECE = 1 << 20
SORT_BYTES = 1 << 17
# Different regions of one name that are compared in one task.
HOT_REGIONS = 2048

_TABLE = np.random.default_rng(97).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A well mixed hash of every ``width`` bytes, by doubling."""
    span, have, built = 1, _TABLE[data], None
    length = 0
    while True:
        if width & span:
            if built is None:
                built, length = have, span
            else:
                # The longer block so far follows this one.
                n = len(data) - length - span + 1
                built = have[:n] * np.uint64(pow(_BASE, length, 1 << 64)) + built[span : span + n]
                length += span
        if span * 2 > width:
            break
        have = have[: len(have) - span] * np.uint64(pow(_BASE, span, 1 << 64)) + have[span:]
        span *= 2
    built = built ^ (built >> np.uint64(31))
    built = built * np.uint64(0xBF58476D1CE4E5B9)
    return built ^ (built >> np.uint64(29))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by doubling."""
    span, least = 1, values
    while span * 2 <= width:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def regions(data: bytes, min_bytes: int) -> tuple[np.ndarray, ...]:
    """Name, first window, number of windows and digest of each region."""
    found: list[tuple[np.ndarray, ...]] = []
    # The longest named substring that has a place to itself for every place of the least hash.
    named = (min_bytes + GRAM) // 2
    places = min_bytes - named + 1
    view, total = memoryview(data), len(data) - min_bytes + 1
    for begin in range(0, max(total, 0), TEXT_PIECE):
        piece = np.frombuffer(view[begin : min(begin + TEXT_PIECE, total) + min_bytes - 1], dtype=np.uint8)
        hashes = gram_hashes(piece, GRAM) & ~np.uint64(255)
        place = np.arange(len(hashes), dtype=np.uint64)
        width = min_bytes - GRAM + 1
        # The low bits hold the place modulo 256, so that the least hash tells where it stands, and the first one if it
        # recurs. A window's places must not wrap round for that: a second count, half way off, serves those that do.
        near = sliding_least(hashes | place & np.uint64(255), width)
        off = sliding_least(hashes | place + np.uint64(128) & np.uint64(255), width)
        window = np.arange(len(near))
        wraps = window & 128 != 0
        least = (np.where(wraps, off, near) & np.uint64(255)).astype(np.int64)
        picked = window + (least - (window & 127)) % places
        starts = np.flatnonzero(np.concatenate(([True], picked[1:] != picked[:-1])))
        counts = np.diff(np.append(starts, len(picked)))
        names = gram_hashes(piece, named)[picked[starts]] >> np.uint64(1)
        digest = xxhash.xxh3_64_intdigest
        stops = starts + counts + (min_bytes - 1)
        digests = [digest(view[begin + a : begin + b]) for a, b in zip(starts.tolist(), stops.tolist())]
        found.append((names, starts + begin, counts, np.array(digests, dtype=np.uint64)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found))


def _find_regions(min_bytes: int):
    """mapInArrow from (key, text) to regions; place packs the first window and the number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            size = 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                name, start, count, digest = regions(text.as_py().encode(), min_bytes)
                packed = start.astype(np.int64) * 128 + count.astype(np.int64)
                values = (name.astype(np.int64), np.full(len(name), key), packed, digest.astype(np.uint64).view(np.int64))
                for column, value in zip(out, values):
                    column.append(value)
                size += len(name)
                if size > 100_000:
                    yield _batch(out)
                    out, size = [[], [], [], []], 0
            if size:
                yield _batch(out)

    return run


def _batch(columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c).astype(np.int64)) for c in columns], names=["name", "key", "place", "digest"]
    )


def suffix_array(symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Suffix order of strings that each end in 0, the ends ordered by owner. Symbols are 0 to 256."""
    n = len(symbols)
    width = 7
    padded = np.concatenate([symbols, np.zeros(width, symbols.dtype)]).astype(np.int64)
    first, alive = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for k in range(width):
        first = first * 512 + np.where(alive, padded[k : k + n], 0)
        alive &= padded[k : k + n] != 0
    # A suffix that ends within the first symbols is unlike all others: its owner settles ties.
    order = np.lexsort((np.where(alive, -1, owner), first))
    sorted_first, sorted_owner = first[order], np.where(alive, -1, owner)[order]
    fresh = np.concatenate(([True], (sorted_first[1:] != sorted_first[:-1]) | (sorted_owner[1:] != sorted_owner[:-1])))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    while not fresh.all():
        # Only suffixes that still tie are sorted again, by the rank of what follows the part compared so far.
        head = np.flatnonzero(fresh)
        size = np.diff(np.append(head, n))
        tied = np.repeat(size > 1, size)
        at = np.flatnonzero(tied)
        who = order[at]
        after = rank[np.minimum(who + width, n - 1)]
        again = np.argsort(rank[who] * (n + 1) + after)
        order[at] = who[again]
        new_after, new_rank = after[again], rank[who][again]
        fresh[at[1:]] = (new_rank[1:] != new_rank[:-1]) | (new_after[1:] != new_after[:-1])
        fresh[at[0]] = True
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        width *= 2
    return order


def shared_prefixes(symbols: np.ndarray, suffixes: np.ndarray, least: int) -> np.ndarray:
    """Whether each suffix shares its first ``least`` symbols with the one before it, by interval expansion."""
    n = len(symbols)
    last = symbols[suffixes - 1]
    by_symbol = np.argsort(last, kind="stable")
    forward = np.empty(n, dtype=np.int64)
    forward[by_symbol] = np.arange(n)
    # The row before and after with the same last symbol; rows of one symbol are neighbours in by_symbol.
    same = last[by_symbol[1:]] == last[by_symbol[:-1]]
    before, after = np.full(n, -1), np.full(n, n)
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    after[by_symbol[:-1][same]] = by_symbol[1:][same]
    known = np.zeros(n + 1, dtype=bool)
    known[[0, n]] = True
    # Length 1: an interval for each symbol, and one for every end.
    counts = np.bincount(symbols, minlength=257)
    ends = counts[0]
    edges = np.cumsum(counts)
    letters = np.flatnonzero(counts[1:]) + 1
    low = np.concatenate([np.arange(ends), edges[letters - 1]])
    high = np.concatenate([np.arange(ends), edges[letters] - 1])
    known[high + 1] = True
    for _ in range(1, least):
        sizes = high - low + 1
        total = int(sizes.sum())
        if not total:
            break
        rows = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
        inner = last[rows] != 0
        first = inner & (before[rows] < np.repeat(low, sizes))
        final = inner & (after[rows] > np.repeat(high, sizes))
        # Extensions of all intervals are disjoint, so their lower and upper ends pair up in order.
        low, high = np.sort(forward[rows[first]]), np.sort(forward[rows[final]])
        fresh = ~known[high + 1]
        low, high = low[fresh], high[fresh]
        known[high + 1] = True
    return ~known[:n]


def repeated_windows(pieces: list[bytes], keys: np.ndarray, starts: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, position) of each window of the pieces that equals one with a smaller key, or the same key and position."""
    lengths = np.array([len(p) for p in pieces])
    joined = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8)
    symbols = joined.astype(np.int64) + 1
    offsets = np.cumsum(lengths + 1) - lengths - 1
    symbols[offsets + lengths] = 0
    owner = np.repeat(np.arange(len(pieces)), lengths + 1)
    suffixes = suffix_array(symbols, owner)
    alike = shared_prefixes(symbols, suffixes, min_bytes)
    group = np.cumsum(~alike)
    many = np.bincount(group)[group] > 1
    at, group = suffixes[many], group[many]
    who = owner[at]
    key, position = keys[who], starts[who] + at - offsets[who]
    order = np.lexsort((position, key, group))
    later = np.zeros(len(order), dtype=bool)
    later[1:] = group[order][1:] == group[order][:-1]
    return key[order][later], position[order][later]


def _spans(key: np.ndarray, position: np.ndarray, min_bytes: int) -> pa.RecordBatch:
    """Windows merged to spans of one row."""
    order = np.lexsort((position, key))
    key, position = key[order], position[order]
    if len(key):
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (position[1:] > position[:-1] + 1)))
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(key)) - 1
        key, low, high = key[head], position[head], position[tail] + min_bytes
    else:
        low = high = position
    return pa.RecordBatch.from_arrays(
        [pa.array(x.astype(np.int64)) for x in (key, low, high)], names=["key", "low", "high"]
    )


def _compare(min_bytes: int):
    """mapInArrow over (name, key, start, bytes) sorted by name: spans that repeat, whole names at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        size, name = 0, None
        for batch in batches:
            for own, key, start, piece in zip(*[c.to_pylist() for c in batch.columns]):
                if own != name and size >= SORT_BYTES:
                    yield flush(held)
                    held, size = [], 0
                held.append((key, start, piece))
                size += len(piece)
                name = own
        if held:
            yield flush(held)

    def flush(held) -> pa.RecordBatch:
        keys, starts = np.array([h[0] for h in held]), np.array([h[1] for h in held])
        return _spans(*repeated_windows([h[2] for h in held], keys, starts, min_bytes), min_bytes)

    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, wanted list) to (name, key, start, bytes)."""
    for batch in batches:
        out = []
        for key, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            data = text.as_py().encode()
            for w in wanted.as_py():
                out.append((w["name"], key, w["start"], data[w["start"] : w["stop"]]))
        if out:
            name, key, start, piece = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(name, pa.int64()), pa.array(key, pa.int64()), pa.array(start, pa.int64()), pa.array(piece, pa.binary())],
                names=["name", "key", "start", "piece"],
            )


def _windows(min_bytes: int):
    """mapInArrow from (name, key, start, bytes) to the digest and place of every window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, start, piece in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)]):
                view = memoryview(piece)
                digests = [xxhash.xxh3_128_digest(view[i : i + min_bytes]) for i in range(len(piece) - min_bytes + 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(digests, pa.binary()),
                        pa.array(np.full(len(digests), key)),
                        pa.array(np.arange(start, start + len(digests))),
                    ],
                    names=["digest", "key", "at"],
                )

    return run


def repeated_spans(texts: DataFrame, min_bytes: int = MIN_BYTES, hot_regions: int = HOT_REGIONS) -> DataFrame:
    """``key``, ``low``, ``high`` of byte spans that go (they may overlap), of distinct texts (``key``, ``text``)."""
    long_enough = texts.where(F.octet_length("text") >= min_bytes)
    found = cut_lineage(long_enough.mapInArrow(_find_regions(min_bytes), "name long, key long, place long, digest long"))
    names = found.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("name")
    start, count = F.shiftright("place", 7), F.col("place").bitwiseAND(127)
    shared = cut_lineage(
        found.join(names, "name", "left_semi").select("name", "digest", "key", start.alias("start"), count.alias("count"))
    )
    discard(found)
    first = F.min(F.struct("key", "start"))
    distinct = cut_lineage(
        shared.groupBy("name", "digest", "count")
        .agg(F.count(F.lit(1)).alias("n"), first.alias("first"))
        .select("name", "digest", "count", "n", F.col("first.key").alias("key"), F.col("first.start").alias("start"))
    )
    stop = F.col("start") + F.col("count") + F.lit(min_bytes - 1)
    copied = distinct.where(F.col("n") > 1).select(
        "name", "digest", "count", F.col("key").alias("first_key"), F.col("start").alias("first_start")
    )
    later = (
        shared.join(copied, ["name", "digest", "count"])
        .where((F.col("key") != F.col("first_key")) | (F.col("start") != F.col("first_start")))
        .select("key", F.col("start").alias("low"), stop.alias("high"))
    )
    per_name = distinct.groupBy("name").agg(F.count(F.lit(1)).alias("kinds"))
    unlike = cut_lineage(distinct.join(per_name.where(F.col("kinds") > 1), "name"))
    wanted = unlike.groupBy("key").agg(
        F.collect_list(F.struct("name", "start", stop.alias("stop"), (F.col("kinds") > hot_regions).alias("hot"))).alias("wanted")
    )
    cut = long_enough.join(wanted, "key")
    few = F.filter("wanted", lambda w: ~w["hot"])
    many = F.filter("wanted", lambda w: w["hot"])
    schema = "name long, key long, start long, piece binary"
    pieces = cut.select("key", "text", few.alias("w")).where(F.size("w") > 0).mapInArrow(_cut_out, schema)
    compared = pieces.repartition("name").sortWithinPartitions("name").mapInArrow(_compare(min_bytes), "key long, low long, high long")
    spans = cut_lineage(later.unionByName(compared))
    if not unlike.where(F.col("kinds") > hot_regions).isEmpty():
        hot = cut.select("key", "text", many.alias("w")).where(F.size("w") > 0).mapInArrow(_cut_out, schema)
        windows = cut_lineage(hot.mapInArrow(_windows(min_bytes), "digest binary, key long, at long"))
        firsts = windows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "at")).alias("first"))
        again = windows.join(firsts.where(F.col("n") > 1), "digest").where(F.struct("key", "at") != F.col("first"))
        more = again.select("key", F.col("at").alias("low"), (F.col("at") + min_bytes).alias("high"))
        spans = cut_lineage(spans.unionByName(more))
        discard(windows)
    discard(shared, distinct, unlike)
    return spans


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, spans) to (id, number of bytes, kept bytes, merged spans)."""
    for batch in batches:
        sizes, kept, merged = [], [], []
        for text, spans in zip(batch.column(1), batch.column(2)):
            data = text.as_py().encode()
            runs: list[list[int]] = []
            for low, high in sorted((s["low"], s["high"]) for s in spans.as_py() or ()):
                if runs and low <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], high)
                else:
                    runs.append([low, high])
            edges = [0, *(x for run in runs for x in run), len(data)]
            sizes.append(len(data))
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            merged.append([{"low": a, "high": b} for a, b in runs])
        span = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(merged, span)],
            names=["id", "n_bytes", "kept", "spans"],
        )


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_bytes: int = MIN_BYTES,
    hot_regions: int = HOT_REGIONS,
) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``kept`` (the bytes that stay) and ``spans`` (low, high) that went."""
    if not GRAM + 2 <= min_bytes <= GRAM + 127:
        raise ValueError(f"min_bytes must lie between {GRAM + 2} and {GRAM + 127}")
    key = free_name(docs, "__key")
    keyed = with_row_key(docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text")), "id", key)
    keyed = keyed.select("id", F.col(key).alias("key"), "text")
    digests = cut_lineage(keyed.select("key", F.sha2("text", 256).alias("sha"), F.octet_length("text").alias("size")))
    firsts = digests.groupBy("sha").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    copies = cut_lineage(
        digests.join(firsts, "sha").where((F.col("key") != F.col("first")) & (F.col("size") >= min_bytes)).select("key", "size")
    )
    spans = repeated_spans(keyed.select("key", "text").join(copies, "key", "left_anti"), min_bytes, hot_regions)
    whole = copies.select("key", F.lit(0).cast("bigint").alias("low"), F.col("size").cast("bigint").alias("high"))
    gone = spans.unionByName(whole).groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("gone"))
    id_type = keyed.schema["id"].dataType.simpleString()
    return (
        keyed.join(gone, "key", "left")
        .select("id", "text", "gone")
        .mapInArrow(_remove, f"id {id_type}, n_bytes long, kept binary, spans array<struct<low: bigint, high: bigint>>")
        .withColumnRenamed("id", id_column)
    )
