"""Closed windows of a stream as complete slots, so that stream and batch share tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowloom.plans.slots import Timescale, from_epoch, next_start, tile
from flowloom.plans.store import SlotStore


def store_windows(
    stream: DataFrame, store: SlotStore, name: str, step: Timescale, checkpoint: str, window: str = "window",
    available_now: bool = False,
) -> StreamingQuery:
    """Write the windows that a stream of tumbling windows closes as slots of ``name``; ``step`` is the window's length.

    All rows of a window come in the batch after the watermark has passed its end, so a batch holds whole slots and a
    repeated one overwrites what it wrote. Windows without rows between stored ones are complete too. The driver
    sees the starts of the windows a batch closes, no rows.
    """

    def keep(batch: DataFrame, _: int) -> None:
        rows = batch.withColumn("slot_start", F.col(f"{window}.start")).drop(window).persist()
        try:
            starts = rows.select(F.unix_timestamp("slot_start").alias("s")).distinct().collect()
            closed = sorted(from_epoch(r.s) for r in starts)
            if not closed:
                return
            stored = [s for s in store.slots_of(name) if s[0] < closed[0]]
            first = max((end for _, end in stored), default=closed[0])
            slots = tile(min(first, closed[0]), next_start(closed[-1], step), step)
            known, own = store.present(name, slots), set(closed)
            store.write(name, rows, [s for s in slots if s[0] in own or s not in known])
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
