"""Per-minute activity series of a host and day: sparse cells, dense arrays, merges, gaps.

``cells`` tables hold one row per (slot, host, minute) with a count; a slot and host never have more
than :data:`BINS` of them, so collecting them into one array is bounded whatever the traffic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.arrays import active_bins, add_series
from flowloom.functions.text import label_missing
from flowloom.functions.times import local_epoch

BINS = 1440
BIN_SECONDS = 60


def minute_cells(
    df: DataFrame, host: str = "host", uid: str = "uid", address: str = "id_resp_h", ts: str = "ts",
    day: str = "day", zone: str = "America/New_York", bins: int = BINS, bin_seconds: int = BIN_SECONDS,
) -> DataFrame:
    """Connections per (day, host, minute), each connection counted at its first log.

    ``day`` is the log day; minutes run from its local midnight. A connection outside that day keeps its
    host with a NULL minute.
    """
    named = df.select(day, uid, address, label_missing(host, address).alias(host), F.col(ts))
    first = named.groupBy(day, uid, address, host).agg(F.min(ts).alias("_ts"))
    minute = F.floor((local_epoch("_ts", zone) - F.unix_timestamp(F.col(day).cast("timestamp"))) / bin_seconds)
    inside = F.when((minute >= 0) & (minute < bins), minute.cast("int"))
    return (
        first.select(day, host, inside.alias("minute"))
        .groupBy(day, host, "minute")
        .agg(F.count(F.lit(1)).cast("int").alias("cnt"))
    )


def dense_array(cells: Column, bins: int = BINS) -> Column:
    """Array of ``bins`` counts from sorted (minute, cnt) structs; linear in its length."""
    previous = lambda i: F.coalesce(F.get(cells, i - 1)["minute"], F.lit(-1))
    pieces = F.transform(
        cells,
        lambda c, i: F.concat(F.array_repeat(F.lit(0), c["minute"] - previous(i) - 1), F.array(c["cnt"])),
    )
    last = F.coalesce(F.get(cells, F.size(cells) - 1)["minute"], F.lit(-1))
    return F.concat(F.flatten(pieces), F.array_repeat(F.lit(0), F.lit(bins - 1) - last))


def to_series(cells: DataFrame, keys: Sequence[str], bins: int = BINS) -> DataFrame:
    """``tdf`` (dense counts) and ``ts_cnt`` (active bins) per key."""
    listed = F.collect_list(F.when(F.col("minute").isNotNull(), F.struct("minute", "cnt")))
    packed = cells.groupBy(*keys).agg(F.array_sort(listed).alias("_cells"))
    return packed.select(
        *keys, dense_array(F.col("_cells"), bins).alias("tdf"), F.size("_cells").alias("ts_cnt")
    )


def build_series(
    df: DataFrame, host: str = "host", uid: str = "uid", address: str = "id_resp_h", ts: str = "ts",
    day: str = "day", zone: str = "America/New_York", bins: int = BINS, bin_seconds: int = BIN_SECONDS,
) -> DataFrame:
    """Daily series of every host."""
    cells = minute_cells(df, host, uid, address, ts, day, zone, bins, bin_seconds)
    return to_series(cells, [day, host], bins)


def merge_protocols(
    http: DataFrame, ssl: DataFrame, keys: Sequence[str] = ("day", "host")
) -> DataFrame:
    """Full outer merge of two protocols' series; ``ts_cnt`` is counted anew."""
    left = http.select(*keys, F.col("tdf").alias("tdf_http"), F.col("ts_cnt").alias("ts_cnt_http"))
    right = ssl.select(*keys, F.col("tdf").alias("tdf_ssl"), F.col("ts_cnt").alias("ts_cnt_ssl"))
    return (
        left.join(right, list(keys), "full")
        .withColumn("tdf", add_series("tdf_http", "tdf_ssl"))
        .withColumn("ts_cnt", active_bins("tdf"))
    )


def merge_sites(
    here: DataFrame, there: DataFrame, keys: Sequence[str] = ("day", "host"), suffixes: tuple[str, str] = ("_a", "_b")
) -> DataFrame:
    """Hosts seen at both sites with added series; ``ts_cnt`` is the sum of both."""
    a, b = suffixes
    rename = lambda df, s: df.select(*keys, *[F.col(c).alias(c + s) for c in df.columns if c not in keys])
    return (
        rename(here, a)
        .join(rename(there, b), list(keys))
        .withColumn("tdf", add_series("tdf" + a, "tdf" + b))
        .withColumn("ts_cnt", F.col("ts_cnt" + a) + F.col("ts_cnt" + b))
    )


def gaps(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Minutes between consecutive active bins; a window holds at most one slot's bins of one host."""
    active = cells.where(F.col("minute").isNotNull() & (F.col("cnt") > 0))
    ordered = Window.partitionBy(*keys).orderBy("minute")
    return (
        active.select(*keys, "minute", (F.col("minute") - F.lag("minute").over(ordered)).alias("gap"))
        .where(F.col("gap").isNotNull())
    )


def gap_profile(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number, smallest, mean and variance of the gaps per key."""
    return gaps(cells, keys).groupBy(*keys).agg(
        F.count("gap").alias("n_gaps"),
        F.min("gap").alias("min_tsinterval"),
        F.avg("gap").alias("mean_gap"),
        F.var_samp("gap").alias("var_gap"),
    )
