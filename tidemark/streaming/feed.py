"""The message feed as a stream into typed stores: items, references, nested rows, attributes, class mapping, freshness.

A micro-batch reads the buckets its keys fall into, of each of the six stores, applies its messages to them as
``apply_feed`` does to whole stores, and rewrites these buckets. Only a batch with a control message (a deleted workflow,
language or attribute, a removed type) reads and rewrites all of the stores it acts on.

One batch number covers the six stores. All six are staged under it before any is put in place, so a batch that died
half way is either worked out again from stores it hasn't touched, or only put in place once more: at-least-once delivery
gives exactly-once results.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import fixed
from tidemark.operators.freshness import ARRIVAL, ITEM_KEY, of_items, without_old_tombstones
from tidemark.operators.lookups import lookup_changes, moved
from tidemark.operators.messages import OWNER_KEY, Stores, batch_rows, is_control, merged
from tidemark.session import cut_lineage
from tidemark.sources.store import BUCKET_BYTES, BUCKETS, BucketStore

KEYS = {
    "freshness": ITEM_KEY,
    "items": ITEM_KEY,
    "references": OWNER_KEY,
    "subtables": OWNER_KEY,
    "attributes": ("ID",),
    "class_attributes": ("ClassID",),
}
LOOKUPS = "lookups"
LOOKUP_KEY = ("item_type", "field", "value")
INITIAL = "initial"


@dataclass(frozen=True)
class FeedStores:
    """Where a feed keeps its stores, all below one shared folder."""

    spark: SparkSession
    root: str
    # Header types of the item columns.
    types: dict[str, str]
    arrival: tuple[str, ...] = ARRIVAL
    buckets: int = BUCKETS
    bucket_bytes: int = BUCKET_BYTES
    # Age, in InsertTime, from which a deleted key is forgotten when its bucket is rewritten; None keeps it for ever.
    forget_after: int | None = None
    # Keep lookup tables of the items, by value, along with them.
    with_lookups: bool = False

    @property
    def names(self) -> list[str]:
        return [*KEYS, LOOKUPS] if self.with_lookups else [*KEYS]

    def store(self, name: str) -> BucketStore:
        keys = KEYS.get(name, LOOKUP_KEY)
        return BucketStore(self.spark, f"{self.root}/{name}", keys, self.buckets, self.bucket_bytes)

    def lookup(self, item_type: str, field: str) -> DataFrame:
        """(LanguageID, value, ID) of one type and field."""
        rows = self.store(LOOKUPS).read()
        return rows.where((F.col("item_type") == item_type) & (F.col("field") == field)).select("LanguageID", "value", "ID")

    def begin(self, attributes: DataFrame, class_attributes: DataFrame) -> None:
        """Start from given attributes and class mapping; beginning again changes nothing."""
        for name, rows in (("attributes", attributes), ("class_attributes", class_attributes)):
            store = self.store(name)
            if store.read() is None:
                store.replace(rows, INITIAL, store.everything())

    def read(self, touched: dict[str, list[int]] | None = None) -> Stores:
        """The stores as they are, whole or in the buckets a batch touches."""
        return Stores(**{n: self.store(n).read(None if touched is None else touched[n]) for n in KEYS})


def _touched(state: FeedStores, rows: DataFrame) -> dict[str, list[int]]:
    """Buckets of each store that a batch may change."""
    if not rows.where(is_control()).isEmpty():
        return {name: state.store(name).everything() for name in KEYS}
    items = cut_lineage(rows.where(of_items()).select(*ITEM_KEY).distinct())
    owners = items.select(F.col("item_type").alias("SourceType"), "type", F.col("ID").alias("ItemID"))
    mapped = rows.where(F.col("type") == fixed.TYPE_MAPPING).select(F.col("ID").alias("ClassID")).distinct()
    emptied = not mapped.where("ClassID = -1").isEmpty()
    of = {
        "freshness": items, "items": items, "references": owners, "subtables": owners,
        "attributes": rows.where(F.col("type") == fixed.TYPE_CONFIGURATION).select("ID"), "class_attributes": mapped,
    }
    found = {name: state.store(name).touched(keys) for name, keys in of.items()}
    # Class -1 empties the whole mapping.
    return found | ({"class_attributes": state.store("class_attributes").everything()} if emptied else {})


def feed_batch(state: FeedStores, batch: DataFrame, batch_id: int | str) -> None:
    """Apply one micro-batch to the stores."""
    if not all(state.store(name).is_staged(batch_id) for name in state.names):
        for name in state.names:
            state.store(name).grow()
        rows = cut_lineage(batch_rows(batch, state.arrival))
        touched = _touched(state, rows)
        known = state.read(touched)
        new = merged(known, rows, state.types, state.arrival)
        if state.forget_after is not None:
            new = replace(new, freshness=without_old_tombstones(new.freshness, rows, state.forget_after))
        for field in fields(new):
            state.store(field.name).stage(getattr(new, field.name), batch_id, touched[field.name])
        if state.with_lookups:
            _stage_lookups(state, known.items, batch_id)
    for name in state.names:
        state.store(name).put(batch_id)


def _stage_lookups(state: FeedStores, before: DataFrame | None, batch_id: int | str) -> None:
    """Retract what the touched items were found by, add what they are found by now: only buckets of these values change."""
    retracted, added = lookup_changes(before, state.store("items").staged_rows(batch_id))
    retracted, added = cut_lineage(retracted), cut_lineage(added)
    store = state.store(LOOKUPS)
    touched = store.touched(retracted.unionByName(added))
    store.stage(moved(store.read(touched), retracted, added), batch_id, touched)


def stream_feed(changes: DataFrame, state: FeedStores, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run the streaming ``changes`` into the stores: all there is and then end, or a batch at each interval ``every``."""
    writer = changes.writeStream.foreachBatch(lambda batch, batch_id: feed_batch(state, batch, batch_id))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
