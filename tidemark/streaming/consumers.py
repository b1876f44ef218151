"""Consumers with their own code per kind of message."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import fixed
from tidemark.functions.maps import without_attributes
from tidemark.operators.feed import route
from tidemark.session import cut_lineage

Hook = Callable[[DataFrame], DataFrame]


def _pass(df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class Consumer:
    """A subscriber: which types it handles, and what to do with each kind of change.

    Hooks take and return DataFrames, so a consumer's code runs as part of one plan.
    """

    name: str
    item_types: list[str]
    on_item: Hook = _pass
    on_record: Hook = _pass
    on_configuration: Hook = _pass
    on_delete: Hook = _pass
    on_initialise: Callable[[], None] | None = None
    on_cleanup: Callable[[], None] | None = None
    handles_initial: bool = True
    dropped_attributes: list[int] = field(default_factory=list)

    def process(self, changes: DataFrame) -> dict[str, DataFrame]:
        """Route changes and run the hook of each kind: item, record, configuration and delete.

        Needs item_type, type, message_kind, Action, correlation_id, sent_priority and fields.
        """
        mine = route(changes, self.item_types, self.name, self.handles_initial)
        deleted = F.col("Action") == fixed.ACTION_DELETE
        data = F.col("type").isin(fixed.TYPE_ITEM, fixed.TYPE_FILE_CONTENT)
        setup = F.col("type").isin(fixed.TYPE_CONFIGURATION, fixed.TYPE_MAPPING)
        record = F.col("message_kind") == fixed.KEY_RECORD
        items = mine.where(~deleted & data & ~record).withColumn(
            "fields", without_attributes("fields", self.dropped_attributes)
        )
        return {
            "item": self.on_item(items),
            "record": self.on_record(mine.where(~deleted & data & record)),
            "configuration": self.on_configuration(mine.where(~deleted & setup)),
            "delete": self.on_delete(mine.where(deleted)),
        }

    def start(
        self, changes: DataFrame, checkpoint: str, sink: Callable[[str, DataFrame, int], None]
    ) -> StreamingQuery:
        """Run on a stream; ``sink`` gets (kind, result, batch number) and must overwrite per batch number."""

        def step(batch: DataFrame, batch_id: int) -> None:
            # Written once, so that the four kinds don't each compute the batch anew.
            for kind, result in self.process(cut_lineage(batch)).items():
                sink(kind, result, batch_id)

        if self.on_initialise:
            self.on_initialise()
        writer = changes.writeStream.foreachBatch(step).trigger(availableNow=True)
        query = writer.option("checkpointLocation", checkpoint).start()
        if self.on_cleanup:
            query.awaitTermination()
            self.on_cleanup()
        return query
