"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowloom.functions.text import _col


def to_time(c: str | Column) -> Column:
    """Timestamp of a time, epoch seconds or text of either; NULL for text that is none (a plain cast would fail under ANSI).

    The type is known before the query runs, so only its branch is left in the plan.
    """
    c = _col(c)
    kind = F.typeof(c)
    seconds = c.cast("string").try_cast("double")
    text = F.coalesce(seconds.try_cast("timestamp"), c.try_cast("timestamp"))
    return F.when(kind.isin("timestamp", "timestamp_ntz", "double"), c.try_cast("timestamp")).otherwise(text)


def epoch_seconds(c: str | Column, digits: int = 6) -> Column:
    """Epoch seconds as double; NULL becomes 0.0."""
    return F.coalesce(F.round(to_time(c).cast("double"), digits), F.lit(0.0))


def parse_time(text: str | Column) -> Column:
    """``yyyy-MM-dd`` when 10 characters long, else ``yyyy-MM-dd HH:mm:ss``; NULL if neither."""
    text = _col(text)
    return F.when(
        F.length(text) == 10, F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))
    ).otherwise(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))


def local_epoch(ts: str | Column, zone: str = "America/New_York") -> Column:
    """Whole seconds of the wall clock in ``zone`` for a UTC time (IANA rules decide about summer time)."""
    return F.unix_timestamp(F.from_utc_timestamp(_col(ts).cast("timestamp"), zone))


def validity_days(before: str | Column, after: str | Column) -> Column:
    """Calendar days between two times."""
    return F.datediff(_col(after), _col(before))


def validity_seconds(before: str | Column, after: str | Column) -> Column:
    return F.unix_timestamp(_col(after)) - F.unix_timestamp(_col(before))


def age_days(ts: str | Column, before: str | Column) -> Column:
    """Fractional days since ``before``."""
    return (F.unix_timestamp(_col(ts)) - F.unix_timestamp(_col(before))) / F.lit(86400)


def days_since(day: str | Column, current: str | Column) -> Column:
    return F.datediff(_col(current), _col(day))


def still_fresh(lastseen: str | Column, current: str | Column, days: int = 30) -> Column:
    """Seen less than ``days`` days ago."""
    return F.datediff(_col(current), _col(lastseen)) < days
