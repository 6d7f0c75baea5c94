"""Popularity of hosts, user agents and URIs, and its extremes over the days before.

``by`` names slot columns: with it one plan covers many slots, without it the whole table is one slot.
Rows are first reduced to (key, client) cells; counts and totals both start from the cells, and the
exchange below them is shared, so the logs are read and shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.text import label_missing, uri_tokens
from flowloom.operators.tables import concat_common


def _distinct_clients(client: str) -> Column:
    """Distinct clients where NULL counts as one of them."""
    return F.countDistinct(client) + F.max(F.col(client).isNull().cast("int"))


def _attach_totals(df: DataFrame, totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the totals of a slot; one slot needs no join, only a scalar subquery.

    The totals are an aggregate of one row per slot, which adaptive execution broadcasts by its real size.
    """
    if by:
        return df.join(totals, list(by))
    row = totals.select(F.struct(*totals.columns)).scalar()
    return df.withColumns({c: row[c] for c in totals.columns})


def client_cells(df: DataFrame, keys: Sequence[str], client: str) -> DataFrame:
    """One row per (key, client) with the number of rows."""
    return df.groupBy(*keys, client).agg(F.count(F.lit(1)).alias("_rows"))


def _same_cells(cells: DataFrame) -> DataFrame:
    # Reading the count keeps both uses of the cells identical for the planner, so the exchange is reused.
    return cells.where(F.col("_rows") > 0)


def host_popularity(
    df: DataFrame, host: str = "host", client: str = "id_orig_h", address: str = "id_resp_h",
    by: Sequence[str] = (),
) -> DataFrame:
    """Distinct clients, logs with a known client, and share of all clients per host."""
    named = df.select(*by, client, label_missing(host, address).alias(host)).where(F.col(host).isNotNull())
    cells = client_cells(named, [*by, host], client)
    per_host = cells.groupBy(*by, host).agg(
        F.count(client).alias("cnt_distinct_hosts"),
        F.sum(F.when(F.col(client).isNotNull(), F.col("_rows")).otherwise(0)).alias("cnt_logs"),
    )
    totals = _same_cells(cells).groupBy(*by).agg(_distinct_clients(client).alias("_clients"))
    return (
        _attach_totals(per_host, totals, by)
        .withColumn("fqdn_norm", F.col("cnt_distinct_hosts") / F.col("_clients"))
        .drop("_clients")
    )


def union_hosts(
    *logs: tuple[DataFrame, str], client: str = "id_orig_h", address: str = "id_resp_h",
    by: Sequence[str] = (),
) -> DataFrame:
    """Logs of several protocols under one host column."""
    parts = [df.select(F.col(name).alias("host"), client, address, *by) for df, name in logs]
    return concat_common(*parts)


def multi_host_popularity(
    *logs: tuple[DataFrame, str], client: str = "id_orig_h", address: str = "id_resp_h",
    by: Sequence[str] = (),
) -> DataFrame:
    """Host popularity over several protocols."""
    union = union_hosts(*logs, client=client, address=address, by=by)
    return host_popularity(union, "host", client, address, by)


def agent_popularity(
    df: DataFrame, agent: str = "user_agent", client: str = "id_orig_h", by: Sequence[str] = (),
) -> DataFrame:
    """Distinct clients and share of all clients per user agent."""
    cells = client_cells(df.where(F.col(agent).isNotNull()), [*by, agent], client)
    per_agent = _same_cells(cells).groupBy(*by, agent).agg(F.count(client).alias("cnt_distinct_hosts"))
    totals = _same_cells(cells).groupBy(*by).agg(_distinct_clients(client).alias("_clients"))
    return (
        _attach_totals(per_agent, totals, by)
        .withColumn("ua_norm", F.col("cnt_distinct_hosts") / F.col("_clients"))
        .drop("_clients")
    )


def _token_cells(cells: DataFrame, uri: str, client: str, by: Sequence[str]) -> DataFrame:
    return cells.select(*by, client, "_rows", F.explode(uri_tokens(uri)).alias("uri_token")).where(
        F.col("uri_token") != ""
    )


def _token_stats(
    cells: DataFrame, uri: str, client: str, by: Sequence[str]
) -> DataFrame:
    # A token repeated in a URI counts each time as a log, once as a client.
    tokens = (
        _token_cells(cells, uri, client, by)
        .groupBy(*by, "uri_token", client)
        .agg(F.sum("_rows").alias("_rows"))
    )
    per_token = tokens.groupBy(*by, "uri_token").agg(
        F.count(client).alias("cnt_distinct_ip_uri_token"), F.sum("_rows").alias("cnt_log_uri_token")
    )
    totals = tokens.groupBy(*by).agg(
        _distinct_clients(client).alias("_clients"), F.sum("_rows").alias("_logs")
    )
    return (
        _attach_totals(per_token, totals, by)
        .withColumn("ip_uri_token_freq", F.col("cnt_distinct_ip_uri_token") / F.col("_clients"))
        .withColumn("log_uri_token_freq", F.col("cnt_log_uri_token") / F.col("_logs"))
        .drop("_clients", "_logs")
    )


def uri_token_stats(
    df: DataFrame, uri: str = "uri", client: str = "id_orig_h", by: Sequence[str] = (),
) -> DataFrame:
    """Clients and logs per URI token, absolute and as a share."""
    cells = client_cells(df.where(F.col(uri).isNotNull()), [*by, uri], client)
    return _token_stats(cells, uri, client, by)


def uri_popularity(
    df: DataFrame, uri: str = "uri", client: str = "id_orig_h", by: Sequence[str] = (),
) -> DataFrame:
    """Per URI the highest of its tokens' four measures; URIs of blank tokens only have none."""
    cells = client_cells(df.where(F.col(uri).isNotNull()), [*by, uri], client)
    stats = _token_stats(cells, uri, client, by)
    uris = (
        _same_cells(cells)
        .select(*by, uri)
        .distinct()
        .select(*by, uri, F.explode(uri_tokens(uri)).alias("uri_token"))
        .where(F.col("uri_token") != "")
    )
    measures = ["cnt_distinct_ip_uri_token", "cnt_log_uri_token", "ip_uri_token_freq", "log_uri_token_freq"]
    return (
        uris.join(stats, [*by, "uri_token"])
        .groupBy(*by, uri)
        .agg(*[F.max(m).alias(f"max_{m}") for m in measures])
    )


HOST_MEASURES = ("cnt_logs", "fqdn_norm", "cnt_distinct_hosts")
AGENT_MEASURES = ("ua_norm", "cnt_distinct_hosts")
URI_MEASURES = (
    "max_cnt_distinct_ip_uri_token", "max_cnt_log_uri_token", "max_ip_uri_token_freq", "max_log_uri_token_freq",
)


def extremes(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], days: int = 5
) -> DataFrame:
    """Minimum and maximum of each measure per key."""
    aggs = []
    for m in measures:
        aggs += [F.min(m).alias(f"min{days}day_{m}"), F.max(m).alias(f"max{days}day_{m}")]
    return df.groupBy(*keys).agg(*aggs)


def trailing_extremes(
    daily: DataFrame, key: str, measures: Sequence[str], day: str = "day", days: int = 5,
    targets: DataFrame | None = None,
) -> DataFrame:
    """Extremes over the ``days`` days before each target day, the day itself excluded.

    Rows move once, by key, where a key has at most one row per day; only then is a row handed to the
    days it counts for, so the copies are never shuffled. Targets default to the days of the table.
    """
    if targets is None:
        targets = daily.select(day)
    targets = targets.select(F.col(day).alias(day)).distinct()
    steps = F.array(*[F.lit(i) for i in range(1, days + 1)])
    handed = (
        daily.repartition(key).select(key, *measures, F.col(day).alias("_from"), F.explode(steps).alias("_step"))
        .select(key, *measures, F.date_add("_from", F.col("_step")).alias(day))
    )
    reduced = extremes(handed, [day, key], measures, days)
    return reduced.join(targets, day, "left_semi")
