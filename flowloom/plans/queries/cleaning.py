"""Cleaning, address and time queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.functions.nets import external_ip, internal_ip, ip_to_long, is_ip, subnet_index
from flowloom.functions.scores import as_flag, is_established
from flowloom.functions.times import days_since, local_epoch, parse_time, still_fresh
from flowloom.operators.cleaning import clean_log, continuous_columns, discrete_columns, range_lookup
from flowloom.plans.queries.bindings import CONN, WEB, Tables, query

BLOCKS = ("10.0.0.0/14", "10.0.0.0/22", "10.0.1.0/24", "10.0.2.0/25", "10.0.6.64/26")
LONG = "(167772160 + (k % 7) * 256 + k)"
SUBNET = f"""CASE WHEN {LONG} BETWEEN 167773760 AND 167773823 THEN 4 WHEN {LONG} BETWEEN 167772672 AND 167772799 THEN 3
  WHEN {LONG} BETWEEN 167772416 AND 167772671 THEN 2 WHEN {LONG} BETWEEN 167772160 AND 167773183 THEN 1 ELSE 0 END"""
ANON = "CASE k % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'home' END"


def _anon():
    return F.when(F.col("k") % 3 == 0, "none").when(F.col("k") % 3 == 1, "home")


@query(
    "int_ext_ip",
    f"""WITH {WEB}, w AS (SELECT event_id, CAST(id_orig_h AS VARCHAR) AS o, id_resp_h AS r, {ANON} AS anon FROM web)
    SELECT event_id, CASE WHEN anon = 'none' THEN r ELSE o END AS internal_ip,
           CASE WHEN anon = 'none' THEN o ELSE r END AS external_ip FROM w""",
)
def int_ext_ip(t: Tables):
    web = t.web().withColumn("anon", _anon()).withColumn("o", F.col("id_orig_h").cast("string"))
    return web.select(
        "event_id", internal_ip("anon", "o", "id_resp_h").alias("internal_ip"),
        external_ip("anon", "o", "id_resp_h").alias("external_ip"),
    )


@query("subnet_index", f"WITH {WEB} SELECT event_id, CAST({SUBNET} AS INTEGER) AS subnet FROM web")
def subnet_index_query(t: Tables):
    return t.web().select("event_id", subnet_index("id_resp_h", BLOCKS).alias("subnet"))


@query(
    "subnet_range_lookup",
    f"""WITH {WEB}, ranges AS (SELECT n_nationkey AS idx, 167772160 + (n_nationkey % 7) * 256 + n_regionkey * 15 AS low,
        167772160 + (n_nationkey % 7) * 256 + n_regionkey * 15 + n_nationkey * 2 AS high FROM nation),
    wide AS (SELECT idx, CASE idx WHEN 0 THEN 0 WHEN 1 THEN 167772673 ELSE low END AS low,
        CASE idx WHEN 0 THEN 4294967295 WHEN 1 THEN 184549374 ELSE high END AS high FROM ranges),
    one AS (SELECT event_id, coalesce(max(idx), -1) AS subnet FROM web LEFT JOIN ranges ON {LONG} BETWEEN low AND high
      GROUP BY event_id),
    two AS (SELECT event_id, coalesce(max(idx), -1) AS wide_subnet FROM web LEFT JOIN wide ON {LONG} BETWEEN low AND high
      GROUP BY event_id)
    SELECT event_id, subnet, wide_subnet FROM one JOIN two USING (event_id)""",
)
def subnet_range_lookup(t: Tables):
    """Narrow ranges, and beside them all addresses and most of a /8."""
    key = F.col("n_nationkey")
    low = F.lit(167772160) + (key % 7) * 256 + F.col("n_regionkey") * 15
    ranges = t.table("nation").select(key.alias("idx"), low.cast("long").alias("low"), (low + key * 2).cast("long").alias("high"))
    bound = lambda name, all_of, most: F.when(F.col("idx") == 0, all_of).when(F.col("idx") == 1, most).otherwise(F.col(name)).alias(name)
    wide = ranges.select("idx", bound("low", 0, 167772673), bound("high", 2**32 - 1, 184549374))
    web = t.web().select("event_id", ip_to_long("id_resp_h").alias("ip"))
    narrow = range_lookup(web, "ip", ranges, "low", "high", "idx", "subnet")
    return range_lookup(narrow, "ip", wide, "low", "high", "idx", "wide_subnet").drop("ip")


@query(
    "clean_schema",
    f"""WITH {WEB} SELECT event_id, round(epoch(ts), 6) AS ts, CAST(id_orig_h AS VARCHAR) AS id_orig_h, id_resp_h,
      CASE WHEN host = '' THEN 'missing' ELSE host END AS host,
      coalesce({ANON}, 'missing') AS anon_orig,
      CAST(CASE WHEN k % 4 = 0 THEN NULL ELSE k % 4 - 1 END AS INTEGER) AS tunnel_parents_len,
      CASE WHEN k % 4 >= 2 THEN 'p' || k ELSE '' END AS first_tunnel_parents,
      CASE WHEN k % 3 = 0 THEN id_resp_h ELSE CAST(id_orig_h AS VARCHAR) END AS "InternalIP",
      CASE WHEN k % 3 = 0 THEN CAST(id_orig_h AS VARCHAR) ELSE id_resp_h END AS "ExternalIP",
      CAST(CASE WHEN k % 3 = 0 THEN {SUBNET} ELSE -1 END AS INTEGER) AS subnet
    FROM web""",
)
def clean_schema(t: Tables):
    """Raw names with dots, lists of length NULL, 0, 1 and 2, NULL hosts."""
    k4 = F.col("k") % 4
    name = F.concat(F.lit("p"), "k")
    raw = t.web().select(
        "event_id", F.col("ts").cast("double").alias("ts"), F.col("id_orig_h").cast("string").alias("id.orig_h"),
        F.col("id_resp_h").alias("id.resp_h"), F.when(F.col("host") != "", F.col("host")).alias("host"),
        _anon().alias("anon_orig"),
        F.when(k4 == 1, F.array().cast("array<string>")).when(k4 == 2, F.array(name)).when(k4 == 3, F.array(name, F.lit("q")))
        .alias("tunnel_parents"),
    )
    return clean_log(raw.withColumn("ts", F.timestamp_micros(F.round(F.col("ts") * 1000000).cast("long"))), BLOCKS).drop("tunnel_parents")


@query(
    "column_classes",
    f"""WITH {CONN} SELECT 'duration' AS name, 'continuous' AS kind, count(duration) AS filled FROM conn
    UNION ALL SELECT 'orig_bytes', 'continuous', count(orig_bytes) FROM conn
    UNION ALL SELECT 'resp_bytes', 'continuous', count(resp_bytes) FROM conn
    UNION ALL SELECT 'conn_state', 'discrete', count(conn_state) FROM conn
    UNION ALL SELECT 'proto', 'discrete', count(proto) FROM conn
    UNION ALL SELECT 'l_linenumber', 'discrete', count(l_linenumber) FROM conn
    UNION ALL SELECT 'l_partkey', 'discrete', count(l_partkey) FROM conn""",
)
def column_classes(t: Tables):
    """Filled rows per column of either class; identifiers are in neither."""
    conn = t.conn()
    kinds = {c: "continuous" for c in continuous_columns(conn)} | {c: "discrete" for c in discrete_columns(conn, wide=True)}
    counts = conn.agg(*[F.count(c).alias(c) for c in kinds])
    rows = [F.struct(F.lit(c).alias("name"), F.lit(k).alias("kind"), F.col(c).alias("filled")) for c, k in kinds.items()]
    return counts.select(F.inline(F.array(*rows)))


@query(
    "tz_shift",
    """SELECT event_id, CAST(epoch(date_trunc('second', (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')) AS BIGINT)
       AS local_ts FROM events""",
)
def tz_shift(t: Tables):
    return t.web().select("event_id", local_epoch("ts").alias("local_ts"))


@query(
    "is_ip",
    f"""WITH {WEB} SELECT event_id, CAST(1 AS INTEGER) AS resp_is_ip, CAST(0 AS INTEGER) AS host_is_ip,
        CAST({LONG} AS BIGINT) AS resp_long FROM web""",
)
def is_ip_query(t: Tables):
    return t.web().select(
        "event_id", is_ip("id_resp_h").alias("resp_is_ip"), is_ip("host").alias("host_is_ip"),
        ip_to_long("id_resp_h").alias("resp_long"),
    )


@query(
    "days_since",
    """SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-01-01') AS days,
       date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-01-01') < 30 AS fresh,
       CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) AS parsed FROM orders""",
)
def days_since_query(t: Tables):
    now = F.lit("2001-01-01").cast("date")
    day = F.col("o_orderdate").cast("date")
    return t.table("orders").select(
        "o_orderkey", days_since(day, now).cast("long").alias("days"), still_fresh(day, now).alias("fresh"),
        F.unix_timestamp(parse_time(F.date_format("o_orderdate", "yyyy-MM-dd"))).alias("parsed"),
    )


@query(
    "conn_state_counts",
    f"""WITH {CONN} SELECT conn_state IN ('SF', 'S1') AS established, proto = 'F' AS flag, count(*) AS n FROM conn GROUP BY ALL""",
)
def conn_state_counts(t: Tables):
    flag = as_flag(F.when(F.col("proto") == "F", "T").otherwise("F"))
    return t.conn().groupBy(is_established("conn_state").alias("established"), flag.alias("flag")).agg(
        F.count(F.lit(1)).alias("n")
    )
