"""Joins: alerts with connections, protocol logs with connections, ranks, blacklists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of alerts and of connections.
ALERT_TO_CONN = {
    "src": "id_orig_h", "dst": "id_resp_h", "spt": "id_orig_p", "dpt": "id_resp_p",
    "anon_src": "anon_orig", "anon_dst": "anon_resp",
}
SWAPPED = {"src": "dst", "dst": "src", "spt": "dpt", "dpt": "spt", "anon_src": "anon_dst", "anon_dst": "anon_src"}
ALERT_TIME_FORMAT = "MMM dd yyyy HH:mm:ss z"


def both_directions(
    alerts: DataFrame, mapping: dict[str, str] = ALERT_TO_CONN, swapped: dict[str, str] = SWAPPED
) -> DataFrame:
    """Alerts under connection column names, once as they are and once with swapped endpoints."""
    rest = [c for c in alerts.columns if c not in mapping]
    direct = F.struct(*[F.col(a).alias(c) for a, c in mapping.items()])
    reverse = F.struct(*[F.col(swapped[a]).alias(c) for a, c in mapping.items()])
    # Unfolding reads the alerts once where a union would read them twice.
    return alerts.select(*rest, F.inline(F.array(direct, reverse)))


def time_band_join(
    conns: DataFrame, alerts: DataFrame, keys: Sequence[str], conn_time: str, alert_time: str, band: float
) -> DataFrame:
    """Rows with equal keys whose times (numbers) differ by at most ``band``.

    The band becomes part of the equi key: alerts are handed to their own cell of the time axis and its
    two neighbours. So a hot key is spread over its cells and only nearby rows meet.
    """
    left = conns.withColumn("_cell", F.floor(F.col(conn_time) / F.lit(band)))
    right = alerts.where(F.col(alert_time).isNotNull()).withColumn(
        "_cell",
        F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)),
                              lambda d: F.floor(F.col(alert_time) / F.lit(band)) + d)),
    )
    return (
        left.join(right, [*keys, "_cell"])
        .where(F.abs(F.col(conn_time) - F.col(alert_time)) <= F.lit(band))
        .drop("_cell")
    )


def alert_match(alerts: DataFrame, conns: DataFrame, band: float = 300.0, on: Sequence[str] = ()) -> DataFrame:
    """Connections with an alert on the same endpoints (either way round) within the band.

    ``rt`` of an alert that does not parse matches nothing; equal result rows are kept once. ``on`` names
    further shared columns, such as a slot.
    """
    alerts = alerts.drop("_lpp_ver", "_lpp_plugin")
    timed = alerts.withColumn(
        "_rt", F.unix_timestamp(F.try_to_timestamp(F.col("rt"), F.lit(ALERT_TIME_FORMAT))).cast("double")
    )
    matched = time_band_join(
        conns, both_directions(timed), [*ALERT_TO_CONN.values(), *on], "ts", "_rt", band
    )
    return matched.drop("_rt").withColumn("fe_label", F.lit(1)).distinct()


def with_connection(
    log: DataFrame, conn: DataFrame, columns: Sequence[str], key: str = "uid", on: Sequence[str] = ()
) -> DataFrame:
    """Every log row with the named columns of its connection; ``on`` names further shared columns.

    A column the log has too is taken from the log and, under ``conn_``, from the connection.
    """
    keys = [key, *on]
    taken = [
        F.col(c).alias(f"conn_{c}" if c in log.columns else c) for c in columns if c not in keys
    ]
    return log.join(conn.select(*keys, *taken), keys, "left")


# Columns taken from the connection log.
CONN_SUMMARY = ("proto", "service", "duration", "conn_state", "history")
SSH_CONN_COLUMNS = (
    "duration", "orig_bytes", "orig_cc", "orig_ip_bytes", "orig_pkts", "resp_bytes", "resp_cc",
    "resp_ip_bytes", "resp_pkts", "service", "community_id", "conn_state", "missed_bytes",
)


def rank_lookup(
    hosts: DataFrame, ranks: DataFrame, host: str = "host", rank: str = "rank", out: str = "cisco1m_index"
) -> DataFrame:
    """One row per host with its position in a rank list, NULL when unranked."""
    first = ranks.groupBy(host).agg(F.min(rank).alias(out))
    return hosts.select(host).distinct().join(first, host, "left")


def brute_force_success(
    df: DataFrame, attempts: str = "auth_attempts", success: str = "auth_success", threshold: int = 3
) -> DataFrame:
    """Sessions that got in after more than ``threshold`` attempts; none if success is not logged."""
    if success not in df.columns:
        return df.where(F.lit(False))
    ok = F.lower(F.col(success).cast("string")).isin("1", "t", "true")
    return df.where((F.col(attempts) > threshold) & ok)


def blacklist_match(
    log: DataFrame, feed: DataFrame, orig: str = "id_orig_h", resp: str = "id_resp_h",
    indicator: str = "indicator", on: Sequence[str] = (),
) -> DataFrame:
    """Rows with a listed endpoint, once for each listed side, flagged by side.

    The two sides are unfolded before one join. ``on`` names further shared columns, such as a day.
    """
    sides = F.array(
        F.struct(F.col(orig).alias("_end"), F.lit(1).alias(f"{orig}_inHoneypot"),
                 F.lit(0).alias(f"{resp}_inHoneypot")),
        F.struct(F.col(resp).alias("_end"), F.lit(0).alias(f"{orig}_inHoneypot"),
                 F.lit(1).alias(f"{resp}_inHoneypot")),
    )
    unfolded = log.select("*", F.inline(sides))
    keyed = feed.withColumn("_end", F.col(indicator))
    return unfolded.join(keyed, ["_end", *on]).drop("_end")


def retro_blacklist_match(
    log: DataFrame, feed: DataFrame, days: int, day: str = "day", orig: str = "id_orig_h",
    resp: str = "id_resp_h", indicator: str = "indicator",
) -> DataFrame:
    """Match against the list published ``days`` days after the log's day."""
    shifted = feed.withColumn(day, F.date_sub(day, days))
    return blacklist_match(log, shifted, orig, resp, indicator, on=[day])
