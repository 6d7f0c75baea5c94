"""First-seen / last-seen history of hosts.

Three equal forms: :func:`history_step` carries a stored day forward, :func:`history_replay` works out
many days in one plan from nothing, :func:`history_continued` from a stored day. A key is forgotten when a day with input finds it idle for the expiry or longer;
a key seen on that very day survives.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowloom.functions.nets import is_ip
from flowloom.functions.text import label_missing
from flowloom.functions.times import days_since, still_fresh

EXPIRY_DAYS = 30


def daily_hosts(
    df: DataFrame, host: str = "host", site: str | None = "anon_host", address: str | None = "id_resp_h",
    by: Sequence[str] = (),
) -> DataFrame:
    """Distinct (host, site) rows without NULLs; blank hosts are named after their address."""
    used = [*by, host, *([site] if site else []), *([address] if address else [])]
    full = _filled(df.select(*used), used)
    name = label_missing(host, address) if address else F.col(host)
    return full.select(*by, name.alias(host), *([site] if site else [])).distinct()


def _filled(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    # One test per column: the planner then knows them and adds none of its own to one use of the rows.
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def empty_history(spark: SparkSession, keys: Sequence[str], log_types: bool = True) -> DataFrame:
    """Typed seed for a history that starts from nothing."""
    cols = [f"{k} string" for k in keys] + ["firstseen_date date", "lastseen_date date"]
    if log_types:
        cols += ["firstseen_log_type string", "lastseen_log_type string"]
    cols += ["count_since_firstseen long", "days_since_firstseen int", "days_since_lastseen int"]
    if log_types:
        cols += ["isIP int"]
    return spark.createDataFrame([], ", ".join(cols))


def history_step(
    history: DataFrame, today: DataFrame, day, keys: Sequence[str], log_type: str | None = "HTTP",
    expiry: int = EXPIRY_DAYS,
) -> DataFrame:
    """The history after ``day`` from the one before it and the day's distinct keys; keys[0] is the host."""
    host = keys[0]
    date = F.lit(day).cast("date")
    seen = today.select(*keys).distinct().withColumn("_seen", F.lit(True))
    hosts = today.select(host).distinct().withColumn("_host_seen", F.lit(1))
    merged = history.join(seen, list(keys), "full").join(hosts, host, "left")
    first = F.coalesce("firstseen_date", date)
    last = F.when(F.col("_seen"), date).otherwise(F.col("lastseen_date"))
    kept = merged.withColumn("_first", first).withColumn("_last", last).where(still_fresh("_last", date, expiry))
    cols = [
        *keys,
        F.col("_first").alias("firstseen_date"),
        F.col("_last").alias("lastseen_date"),
    ]
    if log_type:
        cols += [
            F.coalesce("firstseen_log_type", F.lit(log_type)).alias("firstseen_log_type"),
            F.when(F.col("_seen"), F.lit(log_type)).otherwise(F.col("lastseen_log_type")).alias("lastseen_log_type"),
        ]
    cols += [
        (F.coalesce("count_since_firstseen", F.lit(0)) + F.coalesce("_host_seen", F.lit(0)))
        .cast("long").alias("count_since_firstseen"),
        days_since("_first", date).alias("days_since_firstseen"),
        days_since("_last", date).alias("days_since_lastseen"),
    ]
    if log_type:
        cols += [F.coalesce("isIP", is_ip(host)).alias("isIP")]
    return kept.select(*cols)


def history_replay(
    seen: DataFrame, keys: Sequence[str], day: str = "day", log_type: str | None = "HTTP",
    expiry: int = EXPIRY_DAYS,
) -> DataFrame:
    """The history after every day with input, from distinct (day, keys) rows.

    Windows run over the days of one key, so they are as long as the calendar at most; traffic is reduced
    to days before. Days without input have no rows: their history is the one of the day before.
    """
    host = keys[0]
    per_key = Window.partitionBy(*keys).orderBy(day)
    # The row count keeps the three uses of the reduced rows alike, so the logs are read and shuffled once.
    known = _filled(seen, [host, day])
    days = known.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 0)
    # One row per calendar day with input: its number, and the number of the first day that would expire it.
    calendar = _numbered_days(days, day, expiry)
    runs = (
        days.drop("_rows").join(calendar, day)
        .withColumn("_next", F.lead("_no").over(per_key))
        .withColumn("_prev_expires", F.lag("_expires").over(per_key))
    )
    # A run ends when a day with input expires it before the key returns.
    broken = F.col("_prev_expires").isNull() | (F.col("_prev_expires") < F.col("_no"))
    runs = runs.withColumn("_run", F.sum(broken.cast("int")).over(per_key)).withColumn(
        "_until", F.least(F.coalesce(F.col("_next"), F.col("_end")), F.col("_expires"))
    )
    shown = runs.select(
        *keys, "_run", F.col(day).alias("lastseen_date"),
        F.explode(F.sequence(F.col("_no"), F.col("_until") - 1)).alias("_no"),
    )
    dated = shown.join(calendar.select("_no", day), "_no")
    host_days = days.select(host, day).distinct().withColumn("_host_seen", F.lit(1))
    in_run = Window.partitionBy(*keys, "_run").orderBy(day)
    counted = (
        dated.join(host_days, [host, day], "left")
        .withColumn("firstseen_date", F.min(day).over(in_run))
        .withColumn("count_since_firstseen", F.sum(F.coalesce("_host_seen", F.lit(0))).over(in_run).cast("long"))
    )
    cols = [day, *keys, "firstseen_date", "lastseen_date"]
    if log_type:
        cols += [F.lit(log_type).alias("firstseen_log_type"), F.lit(log_type).alias("lastseen_log_type")]
    cols += [
        "count_since_firstseen",
        days_since("firstseen_date", day).alias("days_since_firstseen"),
        days_since("lastseen_date", day).alias("days_since_lastseen"),
    ]
    if log_type:
        cols += [is_ip(host).alias("isIP")]
    return counted.select(*cols)


def history_continued(
    state: DataFrame, seen: DataFrame, calendar: Sequence[date], keys: Sequence[str], day: str = "day",
    log_type: str | None = "HTTP", expiry: int = EXPIRY_DAYS,
) -> DataFrame:
    """The history after every day of ``calendar``, in one plan, from the state before the first and distinct (day, keys) rows.

    A key of the state enters as a sighting on the day it was last seen, with the count it had. ``calendar`` has the days
    with input, also those on which nothing was seen; its table and the dates up to ``expiry`` before are all the driver makes.
    """
    host = keys[0]
    spark = state.sparkSession
    days = sorted(set(calendar))
    marks = []
    for i in range((days[-1] - days[0]).days + expiry + 1):
        at = days[0] + timedelta(days=i - expiry)
        marks.append((at, bisect_left(days, at + timedelta(days=expiry)) + 1))
    expires = spark.createDataFrame(marks, "_mark date, _expires int")
    numbers = spark.createDataFrame([(d, i + 1) for i, d in enumerate(days)], "_mark date, _no int")
    known = _filled(seen, [host, day]).select(*keys, F.col(day).alias("_mark")).distinct().join(numbers, "_mark")
    typed = "string" if log_type else "void"
    rows = known.select(*keys, "_mark", "_no", F.lit(None).cast("date").alias("_first"), F.lit(0).cast("long").alias("_count"),
                        F.lit(None).cast(typed).alias("_first_type"), F.lit(log_type).cast(typed).alias("_last_type"), F.lit(None).cast("int").alias("_is_ip"))
    types = ["firstseen_log_type", "lastseen_log_type"] if log_type else []
    held = [F.col(c) for c in types] if types else [F.lit(None), F.lit(None)]
    rows = rows.union(state.select(
        *keys, "lastseen_date", F.lit(0), "firstseen_date", "count_since_firstseen", *[c.cast(typed) for c in held],
        F.col("isIP") if log_type else F.lit(None).cast("int"),
    ))
    per_key = Window.partitionBy(*keys).orderBy("_no")
    # A key last seen longer ago than the table of dates reaches goes on the first day with input.
    runs = rows.join(expires, "_mark", "left").withColumn("_expires", F.coalesce("_expires", F.lit(1)))
    runs = runs.withColumn("_next", F.lead("_no").over(per_key)).withColumn("_before", F.lag("_expires").over(per_key))
    broken = F.col("_before").isNull() | (F.col("_before") < F.col("_no"))
    runs = runs.withColumn("_run", F.sum(broken.cast("int")).over(per_key))
    in_run = Window.partitionBy(*keys, "_run")
    until = F.least(F.coalesce("_next", F.lit(len(days) + 1)), "_expires")
    runs = runs.withColumns({
        "_until": until, "firstseen_date": F.min(F.coalesce("_first", "_mark")).over(in_run), "_count": F.max("_count").over(in_run),
        "_first_type": F.max("_first_type").over(in_run), "_is_ip": F.max("_is_ip").over(in_run),
    }).where(F.col("_until") > F.greatest("_no", F.lit(1)))
    shown = runs.select("*", F.explode(F.sequence(F.greatest("_no", F.lit(1)), F.col("_until") - 1)).alias("_at")).drop("_no")
    hosts = known.select(host, F.col("_no").alias("_at")).distinct().withColumn("_host_seen", F.lit(1))
    counted = shown.join(hosts, [host, "_at"], "left").withColumn(
        "count_since_firstseen",
        (F.col("_count") + F.sum(F.coalesce("_host_seen", F.lit(0))).over(in_run.orderBy("_at"))).cast("long"),
    )
    dated = counted.join(numbers.select(F.col("_mark").alias(day), F.col("_no").alias("_at")), "_at")
    cols = [F.col(day), *keys, "firstseen_date", F.col("_mark").alias("lastseen_date")]
    if log_type:
        cols += [F.coalesce("_first_type", F.lit(log_type)).alias("firstseen_log_type"), F.col("_last_type").alias("lastseen_log_type")]
    cols += ["count_since_firstseen", days_since("firstseen_date", day).alias("days_since_firstseen"), days_since("_mark", day).alias("days_since_lastseen")]
    if log_type:
        cols += [F.coalesce("_is_ip", is_ip(host)).alias("isIP")]
    return dated.select(*cols)


def _numbered_days(days: DataFrame, day: str, expiry: int) -> DataFrame:
    # The only unpartitioned window: its input is one row per calendar day.
    ordered = Window.orderBy(day)
    later = Window.orderBy(F.unix_date(day)).rangeBetween(expiry, Window.unboundedFollowing)
    numbered = days.select(day).distinct().withColumn("_no", F.row_number().over(ordered))
    total = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return numbered.withColumn("_end", F.max("_no").over(total) + 1).withColumn(
        "_expires", F.coalesce(F.min("_no").over(later), F.col("_end"))
    )
