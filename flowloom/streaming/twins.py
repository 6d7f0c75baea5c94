"""Streaming twins: tumbling popularity, sliding extremes, history with expiry.

All take an unbounded frame with an event time and emit a window once the watermark has passed it.
"""

from __future__ import annotations

import calendar
from collections.abc import Iterator, Sequence
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flowloom.functions.text import label_missing


def tumbling_hosts(
    logs: DataFrame, ts: str = "ts", host: str = "host", client: str = "id_orig_h", address: str = "id_resp_h",
    length: str = "1 day", delay: str = "1 hour",
) -> DataFrame:
    """Clients and logs per host and tumbling window.

    Clients are counted exactly: a first aggregate per (window, host, client), a second per (window, host).
    """
    named = logs.withWatermark(ts, delay).select(
        F.window(ts, length).alias("window"), label_missing(host, address).alias(host), client
    ).where(F.col(host).isNotNull())
    cells = named.groupBy("window", host, client).agg(F.count(F.lit(1)).alias("_rows"))
    return cells.groupBy("window", host).agg(
        F.count(client).alias("cnt_distinct_hosts"),
        F.sum(F.when(F.col(client).isNotNull(), F.col("_rows")).otherwise(0)).alias("cnt_logs"),
    )


def sliding_extremes(
    logs: DataFrame, ts: str = "ts", host: str = "host", value: str = "cnt_logs", length: str = "5 days",
    step: str = "1 day", delay: str = "1 hour",
) -> DataFrame:
    """Lowest and highest daily count per host over sliding windows."""
    daily = (
        logs.withWatermark(ts, delay)
        .groupBy(F.window(ts, step).alias("_day"), host)
        .agg(F.count(F.lit(1)).alias(value))
        .select(F.window_time("_day").alias("_day_time"), host, value)
    )
    return daily.groupBy(F.window("_day_time", length, step).alias("window"), host).agg(
        F.min(value).alias(f"min5day_{value}"), F.max(value).alias(f"max5day_{value}")
    )


HISTORY_OUT = "{keys}, day date, firstseen_date date, lastseen_date date, count_since_firstseen long"
HISTORY_STATE = "firstseen date, lastseen date, count long, pending array<date>"


def streaming_history(
    logs: DataFrame, keys: Sequence[str], ts: str = "ts", expiry: int = 30, delay: str = "1 hour"
) -> DataFrame:
    """First and last seen day per key, forgotten after more than ``expiry`` days.

    Copies of a key within a day are dropped before, so the state function sees few rows of a hot key.
    A day is counted once the watermark has passed its end, in order, whatever order its rows came in.
    Keys have string type.
    """
    days = (
        logs.withWatermark(ts, delay)
        .withColumn("_day", F.to_date(ts))
        .dropDuplicatesWithinWatermark([*keys, "_day"])
        .select(*keys, ts, "_day")
    )
    schema = HISTORY_OUT.format(keys=", ".join(f"{k} string" for k in keys))
    columns = [*keys, "day", "firstseen_date", "lastseen_date", "count_since_firstseen"]

    def carry(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, last, count, pending = state.get if state.exists else (None, None, 0, [])
        waiting = set(pending)
        if not state.hasTimedOut:
            for batch in batches:
                waiting.update(pd.to_datetime(batch["_day"]).dt.date)
        watermark = state.getCurrentWatermarkMs()
        rows = []
        for day in sorted(d for d in waiting if _end_of(d) <= watermark):
            waiting.discard(day)
            if last is None or (day - last).days > expiry:
                first, count = day, 0
            elif day <= last:
                continue
            last, count = day, count + 1
            rows.append((*key, day, first, last, count))
        if waiting:
            wake = _end_of(min(waiting))
        else:
            wake = _end_of(last + timedelta(days=expiry))
        if wake > watermark:
            state.update((first, last, count, sorted(waiting)))
            state.setTimeoutTimestamp(wake)
        elif state.exists:
            state.remove()  # idle for longer than the expiry
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    return days.groupBy(*keys).applyInPandasWithState(
        carry, schema, HISTORY_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def _end_of(day: date) -> int:
    """End of a UTC day in epoch milliseconds."""
    return calendar.timegm((day + timedelta(days=1)).timetuple()) * 1000
