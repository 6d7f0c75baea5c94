"""Which slots exist, as contiguous ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.plans.slots import slot_rows


def mark_slots(names: DataFrame, start: Column, end: Column, seconds: int, present: DataFrame) -> DataFrame:
    """Every slot of every feature with ``slot_end`` and whether it is in ``present`` (feature, slot_start)."""
    wanted = slot_rows(names, start, end, seconds)
    flagged = present.select("feature", "slot_start").distinct().withColumn("present", F.lit(True))
    return (
        wanted.join(flagged, ["feature", "slot_start"], "left")
        .fillna(False, ["present"])
        .withColumn("slot_end", F.col("slot_start") + F.expr(f"INTERVAL {int(seconds)} SECOND"))
    )


def coverage_ranges(marked: DataFrame) -> DataFrame:
    """Runs of consecutive slots that exist or are missing.

    A window holds the slots of one feature, whose number follows from the range asked for.
    """
    by_time = Window.partitionBy("feature").orderBy("slot_start")
    by_state = Window.partitionBy("feature", "present").orderBy("slot_start")
    island = F.row_number().over(by_time) - F.row_number().over(by_state)
    return (
        marked.withColumn("_island", island)
        .groupBy("feature", "present", "_island")
        .agg(
            F.min("slot_start").alias("range_start"),
            F.max("slot_end").alias("range_end"),
            F.count(F.lit(1)).alias("slots"),
        )
        .drop("_island")
    )


def random_missing(marked: DataFrame, seed: int = 0) -> DataFrame:
    """One missing slot picked at random."""
    return marked.where(~F.col("present")).orderBy(F.rand(seed)).limit(1)
