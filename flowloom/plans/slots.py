"""Time slots: tiling a range, on the driver and as a table. Naive datetimes are UTC."""

from __future__ import annotations

import calendar
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HALF_HOUR = timedelta(minutes=30)
HOUR = timedelta(hours=1)
TWO_HOURS = timedelta(hours=2)
FOUR_HOURS = timedelta(hours=4)
EIGHT_HOURS = timedelta(hours=8)
DAY = timedelta(days=1)
MONTH = "month"
YEAR = "year"

Timescale = timedelta | str
Slot = tuple[datetime, datetime]

STAMP = "yyyyMMdd-HHmm"


def parse_moment(text: str) -> datetime:
    """``%Y-%m-%d`` when 10 characters long, else ``%Y-%m-%d %H:%M:%S``."""
    return datetime.strptime(text, "%Y-%m-%d" if len(text) == 10 else "%Y-%m-%d %H:%M:%S")


def epoch(moment: datetime) -> int:
    return calendar.timegm(moment.timetuple())


def from_epoch(seconds: int) -> datetime:
    return datetime.fromtimestamp(seconds, timezone.utc).replace(tzinfo=None)


def stamp(moment: datetime) -> str:
    return moment.strftime("%Y%m%d-%H%M")


def floor_to(moment: datetime, step: Timescale) -> datetime:
    if step == YEAR:
        return datetime(moment.year, 1, 1)
    if step == MONTH:
        return datetime(moment.year, moment.month, 1)
    return moment - (moment - datetime.min) % step


def next_start(start: datetime, step: Timescale) -> datetime:
    if step == YEAR:
        return datetime(start.year + 1, 1, 1)
    if step == MONTH:
        return datetime(start.year + start.month // 12, start.month % 12 + 1, 1)
    return start + step


def is_slot(start: datetime, end: datetime, step: Timescale) -> bool:
    """The range is exactly one aligned slot."""
    return floor_to(start, step) == start and next_start(start, step) == end


def tile(start: datetime, end: datetime, step: Timescale) -> list[Slot]:
    """Slots of a range.

    A range shorter than a slot widens to the slot around it; one that crosses a slot edge, and a longer
    one that is not aligned at both ends, is an error. Months and years widen within one unit; beyond it
    the start widens to its unit and the end must be the first moment of one.
    """
    if end < start:
        raise ValueError("the start must not lie after the end")
    if isinstance(step, str):
        return _calendar_tiles(start, end, step)
    if end - start < step:
        first = floor_to(start, step)
        if end > first + step:
            raise ValueError("a range shorter than a slot must not cross a slot edge")
        return [(first, first + step)]
    if floor_to(start, step) != start or floor_to(end, step) != end:
        raise ValueError("a range longer than a slot must start and end on slot edges")
    return _steps(start, end, step)


def _steps(start: datetime, end: datetime, step: Timescale) -> list[Slot]:
    slots = []
    while start < end:
        after = next_start(start, step)
        slots.append((start, after))
        start = after
    return slots


def _calendar_tiles(start: datetime, end: datetime, step: str) -> list[Slot]:
    if step not in (MONTH, YEAR):
        raise ValueError(f"unknown timescale {step}")
    first, last = floor_to(start, step), floor_to(end, step)
    if first == last:
        return [(first, next_start(first, step))]
    if end != last:
        raise ValueError(f"a range over several units must end on the first moment of a {step}")
    return _steps(first, last, step)


def moment_lit(moment: datetime) -> Column:
    return F.timestamp_seconds(F.lit(epoch(moment)))


def slot_rows(df: DataFrame, start: Column, end: Column, seconds: int) -> DataFrame:
    """Unfold each row over the slots of its range, as ``slot_start``."""
    step = F.expr(f"INTERVAL {int(seconds)} SECOND")
    return df.select("*", F.explode(F.sequence(start, end - step, step)).alias("slot_start"))


def slot_table(spark: SparkSession, start: datetime, end: datetime, seconds: int) -> DataFrame:
    """The slots of an aligned range as a table."""
    return slot_rows(spark.range(1).select(), moment_lit(start), moment_lit(end), seconds)


def month_table(spark: SparkSession, start: datetime, end: datetime) -> DataFrame:
    """Starts of the months that hold ``start`` to ``end``, both included."""
    months = F.sequence(
        F.date_trunc("month", moment_lit(start)), F.date_trunc("month", moment_lit(end)), F.expr("INTERVAL 1 MONTH")
    )
    return spark.range(1).select(F.explode(months).alias("slot_start"))
