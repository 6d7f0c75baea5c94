"""Stored feature slots: one partitioned Parquet data set per feature and a manifest of complete slots.

A slot is complete once the manifest names it, which happens after its files are committed. A failed or
repeated write overwrites the slot's partition, so writing is idempotent; a slot without rows is complete too.
Rows appended to a slot lie in a data set of their own by slot and batch, so a repeated batch replaces itself.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.operators.tables import trim_columns
from flowloom.plans.slots import STAMP, Slot, Timescale, epoch, from_epoch, moment_lit, stamp, tile
from flowloom.sources.files import exists, listing, modified, remove

#: ``added``: those of the rows that were appended; ``inputs``: what the slot was made from (None: unknown).
MANIFEST = (
    "slot string, start_epoch long, end_epoch long, rows long, written_at timestamp, schema string, status string, "
    "added long, inputs array<string>"
)
COMPLETE, STALE = "complete", "stale"


def _merged_schema(entries: Iterable[T.Row]) -> T.StructType:
    """Columns of all the slots; known from the manifest, so no file footer is read for it."""
    fields: dict[str, T.StructField] = {}
    for text in sorted({e.schema for e in entries}):
        for f in T.StructType.fromJson(json.loads(text)).fields:
            fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    return T.StructType(list(fields.values()))


class SlotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def slot_path(self, name: str, slot: Slot) -> str:
        return f"{self.path(name)}/slot={stamp(slot[0])}"

    def _manifest_path(self, name: str) -> str:
        return f"{self.root}/_slots/{name}"

    def manifest(self, name: str) -> DataFrame:
        """One row per complete slot: the newest entry."""
        path = self._manifest_path(name)
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], MANIFEST)
        entries = self.spark.read.schema(MANIFEST).parquet(path)
        newest = entries.groupBy("slot").agg(F.max_by(F.struct(*entries.columns), "written_at").alias("e")).select("e.*")
        return newest.where(F.coalesce("status", F.lit(COMPLETE)) == COMPLETE)

    def entries(self, name: str, slots: Sequence[Slot]) -> dict[Slot, T.Row]:
        """Newest manifest entries of the slots: a filtered scan of small files without a shuffle."""
        path = self._manifest_path(name)
        if not slots or not exists(self.spark, path):
            return {}
        wanted = {(epoch(s), epoch(e)): (s, e) for s, e in slots}
        low, high = min(k[0] for k in wanted), max(k[0] for k in wanted)
        rows = self.spark.read.schema(MANIFEST).parquet(path).where(F.col("start_epoch").between(low, high)).collect()
        rows.sort(key=lambda r: r.written_at)
        newest = {wanted[(r.start_epoch, r.end_epoch)]: r for r in rows if (r.start_epoch, r.end_epoch) in wanted}
        return {slot: r for slot, r in newest.items() if r.status in (None, COMPLETE)}

    def present(self, name: str, slots: Sequence[Slot]) -> set[Slot]:
        return set(self.entries(name, slots))

    def read(
        self, name: str, slots: Sequence[Slot], columns: Sequence[str] | None = None,
        entries: dict[Slot, T.Row] | None = None,
    ) -> DataFrame | None:
        """Rows of the complete ones among the slots with ``slot_start``; None if there is none.

        The slots become paths and the columns a pruned scan. ``entries`` are theirs, if known already.
        """
        found = self.entries(name, slots) if entries is None else entries
        if not found:
            return None
        schema = _merged_schema(found.values())
        parts = []
        for path, held in ((self.path(name), lambda r: r.rows - (r.added or 0)), (self._added_path(name), lambda r: r.added or 0)):
            stamps = sorted(stamp(s) for (s, _), r in found.items() if held(r))
            if stamps:
                rows = (
                    self.spark.read.schema(T.StructType([*schema.fields, T.StructField("slot", T.StringType())]))
                    .option("basePath", path).parquet(*[f"{path}/slot={s}" for s in stamps])
                )
                parts.append(rows.withColumn("slot_start", F.to_timestamp("slot", STAMP)).drop("slot", "batch"))
        if parts:
            df = reduce(DataFrame.union, parts)
        else:
            df = self.spark.createDataFrame([], schema).withColumn("slot_start", F.lit(None).cast("timestamp"))
        return df if columns is None else trim_columns(df, [*columns, "slot_start"])

    def write(
        self, name: str, df: DataFrame, slots: Sequence[Slot], rebalance: bool = True,
        made_of: dict[Slot, Iterable[str]] | None = None,
    ) -> None:
        """Store the rows of the slots, then declare them complete. ``df`` has ``slot_start``.

        Rebalancing keeps files of even size and splits a hot slot over several tasks; raw logs, read file
        by file, are in slots already and go without that shuffle. ``made_of`` names what each slot was made from.
        """
        if not slots:
            return
        body = df.withColumn("slot", F.date_format("slot_start", STAMP)).drop("slot_start")
        if rebalance:
            body = body.hint("rebalance", "slot")
        seen = Observation()
        (
            body.observe(seen, F.collect_set("slot").alias("slots")).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("slot").parquet(self.path(name))
        )
        # The writer leaves slots without rows as they were; rows of an earlier write and appended ones must go. The
        # slots say so before their files are removed, so that no reader looks for them.
        written = set(seen.get["slots"] or ())
        emptied = [s for s in slots if stamp(s[0]) not in written]
        appended = listing(self.spark, self._added_path(name))
        shape = body.drop("slot").schema
        if emptied:
            self._declare(name, emptied, shape, {}, made_of)
            for slot in emptied:
                remove(self.spark, f"{self.path(name)}/slot={stamp(slot[0])}")
        full = [s for s in slots if stamp(s[0]) in written]
        if full:
            self._declare(name, full, shape, self._row_counts(self.path(name), full), made_of)
        for slot in slots:
            if f"slot={stamp(slot[0])}" in appended:
                remove(self.spark, f"{self._added_path(name)}/slot={stamp(slot[0])}")

    def append(self, name: str, df: DataFrame, slots: Sequence[Slot], batch: str | None = None) -> None:
        """Add rows to slots that may hold some already. A batch that is appended again replaces itself."""
        label = batch or uuid.uuid4().hex
        if not re.fullmatch(r"[\w.-]+", label):
            raise ValueError("a batch is named by letters, digits, points, hyphens and underscores")
        body = df.withColumn("slot", F.date_format("slot_start", STAMP)).drop("slot_start")
        (
            body.withColumn("batch", F.lit(f"b{label}")).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("slot", "batch").parquet(self._added_path(name))
        )
        added = self._row_counts(self._added_path(name), slots)
        before = self.entries(name, slots)
        base = {stamp(s[0]): r.rows - (r.added or 0) for s, r in before.items()}
        # Columns that only the rows before have stay readable.
        shape = _merged_schema([*before.values(), T.Row(schema=body.drop("slot").schema.json())])
        self._declare(name, slots, shape, base, {s: r.inputs for s, r in before.items()}, added)

    def retract(self, name: str, slots: Sequence[Slot]) -> None:
        """The slots count as absent from now on; their files stay until they are written again."""
        held = [s for s in slots if s in self.entries(name, slots)]
        if held:
            self._declare(name, held, T.StructType([]), {}, None, status=STALE)

    def _added_path(self, name: str) -> str:
        return f"{self.root}/_added/{name}"

    def append_moment(self, name: str, df: DataFrame, start: datetime, end: datetime, step: Timescale) -> None:
        """Add rows to the slot a short range lies in."""
        slot = tile(start, end, step)[0]
        self.append(name, df.withColumn("slot_start", moment_lit(slot[0])), [slot])

    def _declare(
        self, name: str, slots: Sequence[Slot], schema: T.StructType, rows: dict[str, int],
        made_of: dict[Slot, Iterable[str] | None] | None = None, added: dict[str, int] | None = None, status: str = COMPLETE,
    ) -> None:
        text, made_of, added = schema.json(), made_of or {}, added or {}
        entries = []
        for slot in slots:
            own, more, inputs = stamp(slot[0]), added.get(stamp(slot[0]), 0), made_of.get(slot)
            inputs = None if inputs is None else sorted(inputs)
            entries.append((own, epoch(slot[0]), epoch(slot[1]), rows.get(own, 0) + more, text, status, more, inputs))
        shape = "slot string, start_epoch long, end_epoch long, rows long, schema string, status string, added long, inputs array<string>"
        (
            self.spark.createDataFrame(entries, shape)
            .withColumn("written_at", F.current_timestamp())
            .select(*[f.split()[0] for f in MANIFEST.split(", ")])
            .coalesce(1)
            .write.mode("append").parquet(self._manifest_path(name))
        )

    def _row_counts(self, root: str, slots: Iterable[Slot]) -> dict[str, int]:
        # Counting needs the file footers only, not the data.
        there = listing(self.spark, root)
        folders = [f"{root}/{f}" for f in (f"slot={stamp(s)}" for s, _ in slots) if f in there]
        if not folders:
            return {}
        counted = self.spark.read.option("basePath", root).parquet(*folders).groupBy("slot").count()
        return {r["slot"]: r["count"] for r in counted.collect()}

    def slots_of(self, name: str) -> list[Slot]:
        rows = self.manifest(name).select("start_epoch", "end_epoch").collect()
        return sorted((from_epoch(r.start_epoch), from_epoch(r.end_epoch)) for r in rows)

    def describe(self, name: str, slot: Slot) -> dict:
        """Path, modification time, number of columns and columns of one stored slot."""
        df = self.read(name, [slot])
        if df is None:
            raise FileNotFoundError(self.slot_path(name, slot))
        columns = [c for c in df.columns if c != "slot_start"]
        path = self.slot_path(name, slot)
        return {
            "path": path,
            "modified": modified(self.spark, path) if exists(self.spark, path) else None,
            "count": len(columns),
            "columns": columns,
        }
