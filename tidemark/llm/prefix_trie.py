"""The trie of conversation prefixes, with count-min screening of prefix digests.

Every distinct sequence of first d turns (role and text) is a node; conversations that start with it are its members. A
prefix is named by a 128-bit digest: the sum, lane by lane, of the digests of its turns with their places. Sums run
along conversations of any length, so a giant one is cut into chunks like any ordered key.

1. A count-min sketch of all prefix digests is made map-side, a sketch of two bits a cell per task (seen, seen again), and
   merged by bit operations. An estimate of one proves that a prefix has one member: the node is emitted where it lies, no
   shuffle sees it. Only prefixes that are possibly shared are shuffled and grouped exactly. Chance collisions in the
   sketch send a few too many that way, never too few, so results don't depend on its width.
2. A node is owned by its smallest member, and then that member owns every node further down its own path. So one number
   per conversation, the depth from which it owns its path, turns all sums over subtrees into sums over members: a node's
   leaves, children and saved bytes are added up in one grouping, map-side combined, without walking the trie.
3. A node's list of ending members is hashed as a stream of sorted ids: ranges of ids are joined by many tasks into
   chunks, and only chunks come together in order.

Only the merged sketch is broadcast: ``ROWS`` x ``MAX_WIDTH`` bits at most, 64 MB. Beyond some 10**8 prefixes it screens
out fewer, and more are grouped exactly.

Defined cases: rows without a conversation id belong to no conversation; null role and text count as empty; rows of one
turn (nulls first) are ordered by the digest of role and text, and repeated rows are turns like any other; conversations
without turns are members of the root; an empty table has no node, not even the root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import HOT_ROWS, Running, chunk_of, running
from tidemark.session import cut_lineage

# Rows of the sketch, and cells of a row: four per prefix, up to the bound.
ROWS = 4
MAX_WIDTH = 1 << 27
MIN_WIDTH = 1 << 12
# Bytes of one bit plane that travel together.
BLOCK = 1 << 13
# Ids hashed as one chunk.
IDS = 1 << 15
NODE = ["k1", "k2", "depth"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """Digest of a turn; the length of the role keeps role and text apart."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def numbered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             hot_rows: int = HOT_ROWS) -> DataFrame:
    """Turns by their place (from 1) in their conversation: conv_id, place, digest, bytes (of the text)."""
    narrow = cut_lineage(
        turns.where(F.col(conv).isNotNull()).select(
            F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"),
            turn_digest(F.col(role), F.col(text)).alias("digest"),
            F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("bigint").alias("bytes"),
        )
    )
    order = [F.col("turn"), F.col("digest")]
    placed = running(narrow, ["conv_id"], order, None, Running("place", "count"), limit=hot_rows)
    return placed.select("conv_id", "place", "digest", "bytes")


def grafted(turns: DataFrame, heads: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first ``heads`` turns replaced by the first ``heads`` of conversation ``base``.

    ``heads`` (at most ``most``) and ``base`` are expressions of conv_id; ``turns`` come from ``numbered``. A base with
    fewer turns gives all it has, an absent one none. Returns conversations (conv_id, length) and turns (conv_id, depth,
    digest, bytes).
    """
    own = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    first = turns.where(F.col("place") <= most).groupBy(F.col("conv_id").alias("__base")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "bytes"))).alias("head")
    )
    based = own.select("conv_id", "own", heads.cast("bigint").alias("heads"), base.alias("__base")).join(first, "__base", "left")
    given = F.filter("head", lambda t: t["place"] <= F.col("heads"))
    none = F.array().cast(first.schema["head"].dataType)
    based = based.select("conv_id", "own", "heads", F.coalesce(given, none).alias("head"))
    based = cut_lineage(based.withColumn("given", F.size("head").cast("bigint")))
    rest = F.greatest(F.col("own") - F.col("heads"), F.lit(0))
    conversations = based.select("conv_id", (F.col("given") + rest).alias("length"))
    front = based.select("conv_id", F.inline("head")).withColumnRenamed("place", "depth")
    kept = turns.join(based.where(F.col("own") > F.col("heads")).select("conv_id", "heads", "given"), "conv_id")
    back = kept.where(F.col("place") > F.col("heads")).select(
        "conv_id", (F.col("place") - F.col("heads") + F.col("given")).alias("depth"), "digest", "bytes"
    )
    return conversations, front.unionByName(back)


def prefixes(conversations: DataFrame, turns: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every prefix of every conversation: conv_id, depth, its digest (k1, k2), that of the prefix before it (p1, p2),
    bytes of its last turn, bytes of all (``upto``) and whether the conversation ends here (``last``)."""
    lanes = [f"l{i}" for i in range(4)]
    mixed = turns.withColumn("__m", F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest"))))
    for i, lane in enumerate(lanes):
        mixed = mixed.withColumn(lane, F.conv(F.substring("__m", 1 + 8 * i, 8), 16, 10).cast("bigint"))
    mixed = mixed.join(conversations, "conv_id").select("conv_id", "depth", "bytes", "length", *lanes)
    hot = cut_lineage(conversations.where(F.col("length") > hot_rows).select(F.col("conv_id").alias("__h_conv_id")))
    # Depths are positions, so spans of them are chunks of equal size.
    sums = running(
        mixed, ["conv_id"], [F.col("depth")], chunk_of(F.col("depth"), max(1, hot_rows)),
        *[Running(f"s{i}", "sum", F.col(lane)) for i, lane in enumerate(lanes)], Running("upto", "sum", F.col("bytes")),
        hot=hot,
    )

    def pair(high: Column, low: Column) -> Column:
        """Two lanes, each modulo 2**32, in one long."""
        mask = F.lit(0xFFFFFFFF)
        return F.shiftleft(high.bitwiseAND(mask), 32).bitwiseOR(low.bitwiseAND(mask))

    now = [F.col(f"s{i}") for i in range(4)]
    before = [F.col(f"s{i}") - F.col(f"l{i}") for i in range(4)]
    return sums.select(
        "conv_id", "depth", pair(now[0], now[1]).alias("k1"), pair(now[2], now[3]).alias("k2"),
        pair(before[0], before[1]).alias("p1"), pair(before[2], before[3]).alias("p2"), "bytes", "upto",
        (F.col("depth") == F.col("length")).alias("last"),
    )


def cells(k1: np.ndarray, k2: np.ndarray, width: int) -> np.ndarray:
    """Cell of each key in each row of the sketch, by double hashing."""
    one, two = k1.astype(np.uint64), k2.astype(np.uint64) | np.uint64(1)
    shift = np.uint64(64 - (width.bit_length() - 1))
    return np.stack([((one + np.uint64(j) * two) * np.uint64(0x9E3779B97F4A7C15)) >> shift for j in range(ROWS)]).astype(np.int64)


def _is_set(plane: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (plane[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0


class Sketch:
    """Counts saturated at two, as bit planes: seen, and seen again."""

    def __init__(self, width: int):
        self.width = width
        self.seen = np.zeros((ROWS, width // 8), dtype=np.uint8)
        self.again = np.zeros((ROWS, width // 8), dtype=np.uint8)

    def add(self, k1: np.ndarray, k2: np.ndarray) -> None:
        for j, places in enumerate(cells(k1, k2, self.width)):
            places, number = np.unique(places, return_counts=True)
            more = places[(number > 1) | _is_set(self.seen[j], places)]
            for plane, at in ((self.again[j], more), (self.seen[j], places)):
                np.bitwise_or.at(plane, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))


BLOCKS = "block bigint, seen binary, again binary"


def _block_batch(blocks: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    number, seen, again = zip(*blocks)
    return pa.RecordBatch.from_arrays(
        [pa.array(number, pa.int64()), pa.array(seen, pa.binary()), pa.array(again, pa.binary())],
        names=["block", "seen", "again"],
    )


def _sketched(width: int):
    """A task's prefixes as the blocks of one sketch that hold anything."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(width)
        for batch in batches:
            if batch.num_rows:
                sketch.add(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        seen, again = sketch.seen.reshape(-1), sketch.again.reshape(-1)
        for start in range(0, len(seen), BLOCK):
            part = seen[start : start + BLOCK]
            if part.any():
                yield _block_batch([(start // BLOCK, part.tobytes(), again[start : start + BLOCK].tobytes())])

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a number become one: seen again is what either saw again, or both saw. Holds one sketch at most."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for number, seen, again in zip(*(c.to_pylist() for c in batch.columns)):
            seen, again = np.frombuffer(seen, np.uint8), np.frombuffer(again, np.uint8)
            if number in held:
                s, a = held[number]
                seen, again = s | seen, a | again | (s & seen)
            held[number] = (seen, again)
    for number, (seen, again) in held.items():
        yield _block_batch([(number, seen.tobytes(), again.tobytes())])


def shared_cells(keys: DataFrame, width: int) -> np.ndarray:
    """Bit planes (``ROWS`` of them) of the cells that two or more of the keys fall into."""
    blocks = keys.select("k1", "k2").mapInArrow(_sketched(width), BLOCKS)
    # First among a few tasks' sketches, then all: no merging task reads every task's block.
    some = blocks.withColumn("salt", F.spark_partition_id() % 32).repartition("block", "salt").drop("salt")
    merged = some.mapInArrow(_merged, BLOCKS).repartition("block").mapInArrow(_merged, BLOCKS)
    planes = np.zeros(ROWS * width // 8, dtype=np.uint8)
    for r in merged.select("block", "again").toLocalIterator():
        planes[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["again"], np.uint8)
    return planes.reshape(ROWS, -1)


def _screened(planes, width: int, names: list[str]):
    """Rows with ``shared`` and ``parent_shared``: whether the prefix, and the one before it, may have other members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = []
            for one, two in (("k1", "k2"), ("p1", "p2")):
                places = cells(batch.column(names.index(one)).to_numpy(), batch.column(names.index(two)).to_numpy(), width)
                flags.append(np.logical_and.reduce([_is_set(p, at) for p, at in zip(planes.value, places)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, flags)], names=[*names, "shared", "parent_shared"])

    return run


def screened(found: DataFrame) -> DataFrame:
    """``found`` (see ``prefixes``) with the sketch's word on each prefix and the one before it."""
    prefix_count = found.count()
    width = min(MAX_WIDTH, max(MIN_WIDTH, 1 << (4 * max(1, prefix_count) - 1).bit_length()))
    planes = found.sparkSession.sparkContext.broadcast(shared_cells(found, width))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    return found.mapInArrow(_screened(planes, width, found.columns), f"{types}, shared boolean, parent_shared boolean")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, id) rows as chunks: the ids of one node, as text, with the first of them."""
    key, ids = None, []

    def chunk():
        return pa.RecordBatch.from_pylist(
            [{"k1": key[0], "k2": key[1], "depth": key[2], "first": ids[0], "text": ",".join(map(str, ids))}]
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and (row[:3] != key or len(ids) >= IDS):
                yield chunk()
                ids = []
            key = row[:3]
            ids.append(row[3])
    if ids:
        yield chunk()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks as one digest per node; a digest goes on through any number of batches."""
    key, state = None, None

    def done():
        return pa.RecordBatch.from_pylist([{"k1": key[0], "k2": key[1], "depth": key[2], "ends_sha256": state.hexdigest()}])

    for batch in batches:
        for k1, k2, depth, _, text in zip(*(c.to_pylist() for c in batch.columns)):
            if state is not None and (k1, k2, depth) == key:
                state.update(b",")
            else:
                if state is not None:
                    yield done()
                key, state = (k1, k2, depth), hashlib.sha256()
            state.update(text.encode())
    if state is not None:
        yield done()


def digests_of_ids(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's comma-joined ids, ascending: ``NODE``, ends_sha256. ``ends``: ``NODE``, conv_id."""
    by = [*NODE, "conv_id"]
    ranged = ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by)
    chunks = cut_lineage(ranged.mapInArrow(_joined_ids, "k1 bigint, k2 bigint, depth bigint, first bigint, text string"))
    brought = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return brought.mapInArrow(_hashed, "k1 bigint, k2 bigint, depth bigint, ends_sha256 string")


def trie(conversations: DataFrame, turns: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per node: conv_id (smallest member; with ``depth`` it names the node and its texts), depth, parent_conv_id
    (the parent's conv_id), n_convs, n_children, n_leaves, saved_tokens (bytes of last texts that more than one member
    has, over the subtree) and ends_sha256 (of the members that end here).

    ``conversations``: conv_id, length, no conv_id twice; ``turns``: conv_id, depth (1 to length), digest, bytes.
    """
    conversations = cut_lineage(conversations.select("conv_id", "length"))
    turns = cut_lineage(turns)
    found = cut_lineage(screened(cut_lineage(prefixes(conversations, turns, hot_rows))))
    shared, single = found.where("shared"), found.where(~F.col("shared"))

    # From which depth on each conversation owns its path, the bytes before that, and whether it owns a leaf.
    groups = shared.groupBy(*NODE).agg(
        F.min(F.struct("conv_id", (F.col("upto") - F.col("bytes")).alias("before"))).alias("first"),
        F.min("last").alias("leaf"),
    )
    owned = groups.select("first.conv_id", "depth", "first.before", "leaf").unionByName(
        single.select("conv_id", "depth", (F.col("upto") - F.col("bytes")).alias("before"), F.col("last").alias("leaf"))
    )
    ended = found.where("last").select(
        "conv_id", (F.col("depth") + 1).alias("depth"), F.col("upto").alias("before"), F.lit(False).alias("leaf")
    )
    owners = owned.unionByName(ended).groupBy("conv_id").agg(
        F.min(F.struct("depth", "before")).alias("own"), F.max("leaf").cast("bigint").alias("leaf")
    )
    owners = cut_lineage(owners.select("conv_id", F.col("own.depth").alias("own_from"), F.col("own.before").alias("unowned"), "leaf"))

    further = F.col("own_from") > F.col("depth")
    nodes = shared.join(owners, "conv_id").groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(((F.col("own_from") <= F.col("depth") + 1) & ~F.col("last")).cast("bigint")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.when(further, F.col("unowned") - F.col("upto") + F.col("bytes")).otherwise(0)).alias("saved_tokens"),
    )
    nodes = cut_lineage(nodes)
    nodes_with_ends = nodes.join(digests_of_ids(shared.where("last")), NODE, "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))
    )
    tails = single.select(
        *NODE, "conv_id", "p1", "p2", F.lit(1).cast("bigint").alias("n_convs"),
        (~F.col("last")).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
        "parent_shared",
    )

    root_owner = conversations.agg(F.min("conv_id").alias("c")).scalar()
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    # Only the first node of a tail may hang below somebody else's; the rest of it stays where it is.
    top, local = F.col("depth") == 1, ~F.col("parent_shared")
    below_root = nodes_with_ends.where(top).unionByName(tails.where(top).drop("parent_shared"))
    asking = nodes_with_ends.where(~top).unionByName(tails.where(~top & ~local).drop("parent_shared"))
    parents = nodes.select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id")
    )
    # A parent that was never grouped is proven to have one member, which is the node's own.
    parent = F.coalesce("parent_conv_id", "conv_id")
    return (
        below_root.withColumn("parent_conv_id", root_owner).select(*out)
        .unionByName(asking.join(parents, ["p1", "p2", "depth"], "left").withColumn("parent_conv_id", parent).select(*out))
        .unionByName(tails.where(~top & local).withColumn("parent_conv_id", F.col("conv_id")).select(*out))
        .unionByName(_root(conversations, owners).select(*out))
    )


def _root(conversations: DataFrame, owners: DataFrame) -> DataFrame:
    """The node without turns: one row, none if there is no conversation. All of its sums combine map-side."""
    sums = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    below = owners.agg(
        F.coalesce(F.sum((F.col("own_from") == 1).cast("bigint")), F.lit(0)).alias("n_children"),
        # Without a turn anywhere the root is the only leaf.
        F.greatest(F.coalesce(F.sum("leaf"), F.lit(0)), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("unowned"), F.lit(0)).alias("saved_tokens"),
    )
    zero = F.lit(0).cast("bigint")
    ends = digests_of_ids(conversations.where("length = 0").select(zero.alias("k1"), zero.alias("k2"), zero.alias("depth"), "conv_id"))
    return (
        sums.withColumn("depth", zero)
        .join(F.broadcast(below.withColumn("depth", zero)), "depth")
        .join(F.broadcast(ends.select("depth", "ends_sha256")), "depth", "left")
        .withColumns({"ends_sha256": F.coalesce("ends_sha256", F.lit(NO_ENDS)), "parent_conv_id": F.lit(None).cast("bigint")})
    )
