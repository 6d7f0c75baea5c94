"""Popularity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.operators import conn_stats, popularity
from flowloom.operators.popularity import AGENT_MEASURES, HOST_MEASURES, URI_MEASURES
from flowloom.plans.queries.bindings import NAMED, WEB, Tables, query


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _host_sql(source: str, by: str = "") -> str:
    total = (
        f"(SELECT count(DISTINCT id_orig_h) + max(CASE WHEN id_orig_h IS NULL THEN 1 ELSE 0 END) FROM {source} t"
        + (f" WHERE t.{by} = s.{by})" if by else ")")
    )
    head = f"{by}, " if by else ""
    return (
        f"SELECT {head}host, count(DISTINCT id_orig_h) AS cnt_distinct_hosts, count(id_orig_h) AS cnt_logs, "
        f"count(DISTINCT id_orig_h) / {total} AS fqdn_norm FROM {source} s WHERE host IS NOT NULL GROUP BY {head}host"
    )


@query(
    "popularity_host",
    f"WITH {NAMED}, p AS ({_host_sql('named')}) SELECT * REPLACE (round(fqdn_norm, 6) AS fqdn_norm) FROM p",
)
def popularity_host(t: Tables):
    return _rounded(popularity.host_popularity(t.web()), "fqdn_norm")


DAY_TOTALS = ", totals AS (SELECT day, count(DISTINCT id_orig_h) AS n FROM named GROUP BY day)"
DAILY_HOST = (
    NAMED + DAY_TOTALS + """, daily AS (
  SELECT day, host, count(DISTINCT id_orig_h) AS cnt_distinct_hosts, count(id_orig_h) AS cnt_logs,
         count(DISTINCT id_orig_h) / any_value(n) AS fqdn_norm
  FROM named JOIN totals USING (day) GROUP BY day, host)"""
)


@query(
    "popularity_host_daily",
    f"WITH {DAILY_HOST} SELECT * REPLACE (round(fqdn_norm, 6) AS fqdn_norm) FROM daily",
)
def popularity_host_daily(t: Tables):
    web = t.web()
    return _rounded(popularity.host_popularity(web, by=["day"]), "fqdn_norm")


AGENT = """SELECT user_agent, count(DISTINCT id_orig_h) AS cnt_distinct_hosts,
  count(DISTINCT id_orig_h) / (SELECT count(DISTINCT id_orig_h) FROM web) AS ua_norm
  FROM web WHERE user_agent IS NOT NULL GROUP BY user_agent"""


@query("popularity_ua", f"WITH {WEB}, p AS ({AGENT}) SELECT * REPLACE (round(ua_norm, 6) AS ua_norm) FROM p")
def popularity_ua(t: Tables):
    return _rounded(popularity.agent_popularity(t.web()), "ua_norm")


@query(
    "httpssl_popularity_host",
    f"""WITH {NAMED}, both_logs AS (
      SELECT host, id_orig_h FROM named WHERE uid % 2 = 0 UNION ALL SELECT host, id_orig_h FROM named WHERE uid % 2 = 1),
    p AS ({_host_sql('both_logs')}) SELECT * REPLACE (round(fqdn_norm, 6) AS fqdn_norm) FROM p""",
)
def httpssl_popularity_host(t: Tables):
    """Even connections play the web log, odd ones the TLS log."""
    web = t.web()
    http = web.where(F.col("uid") % 2 == 0)
    ssl = web.where(F.col("uid") % 2 == 1).withColumnRenamed("host", "server_name")
    return _rounded(popularity.multi_host_popularity((ssl, "server_name"), (http, "host")), "fqdn_norm")


PAGES = """logs AS (SELECT url AS uri, page_id % 20 AS id_orig_h, DATE '2024-01-01' + CAST(page_id % 10 AS INTEGER) AS day
  FROM pages)"""
TOKENS = """tokens AS (SELECT * FROM (SELECT day, uri, id_orig_h, unnest(string_split(uri, '/')) AS uri_token FROM logs)
  WHERE uri_token <> '')"""
TOKEN_STATS = """stats AS (
  SELECT uri_token, count(DISTINCT id_orig_h) AS cnt_distinct_ip_uri_token, count(*) AS cnt_log_uri_token,
         count(DISTINCT id_orig_h) / (SELECT count(DISTINCT id_orig_h) FROM tokens) AS ip_uri_token_freq,
         count(*) / (SELECT count(*) FROM tokens) AS log_uri_token_freq
  FROM tokens GROUP BY uri_token)"""


def _uri_logs(t: Tables):
    return t.table("pages").select(
        F.col("url").alias("uri"),
        (F.col("page_id") % 20).alias("id_orig_h"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 10).cast("int")).alias("day"),
    )


@query(
    "uri_token_stats",
    f"""WITH {PAGES}, {TOKENS}, {TOKEN_STATS} SELECT * REPLACE (round(ip_uri_token_freq, 6) AS ip_uri_token_freq,
      round(log_uri_token_freq, 6) AS log_uri_token_freq) FROM stats""",
)
def uri_token_stats(t: Tables):
    return _rounded(popularity.uri_token_stats(_uri_logs(t)), "ip_uri_token_freq", "log_uri_token_freq")


@query(
    "popularity_uri",
    f"""WITH {PAGES}, {TOKENS}, {TOKEN_STATS}
    SELECT uri, max(cnt_distinct_ip_uri_token) AS max_cnt_distinct_ip_uri_token,
           max(cnt_log_uri_token) AS max_cnt_log_uri_token,
           round(max(ip_uri_token_freq), 6) AS max_ip_uri_token_freq,
           round(max(log_uri_token_freq), 6) AS max_log_uri_token_freq
    FROM tokens JOIN stats USING (uri_token) GROUP BY uri""",
)
def popularity_uri(t: Tables):
    return _rounded(popularity.uri_popularity(_uri_logs(t)), "max_ip_uri_token_freq", "max_log_uri_token_freq")


def _extreme_sql(key: str, measures) -> str:
    cols = ", ".join(
        f"round({fn}(p.{m}), 6) AS {fn}5day_{m}" if m.endswith(("norm", "freq")) else f"{fn}(p.{m}) AS {fn}5day_{m}"
        for m in measures for fn in ("min", "max")
    )
    return (
        f"SELECT d.day, p.{key}, {cols} FROM (SELECT DISTINCT day FROM daily) d "
        f"JOIN daily p ON p.day BETWEEN d.day - 5 AND d.day - 1 GROUP BY d.day, p.{key}"
    )


def _extremes(daily, key, measures):
    ratios = [f"{fn}5day_{m}" for m in measures for fn in ("min", "max") if m.endswith(("norm", "freq"))]
    return _rounded(popularity.trailing_extremes(daily, key, measures), *ratios)


@query("fiveday_popularity_host", f"WITH {DAILY_HOST} {_extreme_sql('host', HOST_MEASURES)}")
def fiveday_popularity_host(t: Tables):
    web = t.web()
    return _extremes(popularity.host_popularity(web, by=["day"]), "host", HOST_MEASURES)


@query(
    "fiveday_popularity_ua",
    f"""WITH {WEB}, totals AS (SELECT day, count(DISTINCT id_orig_h) AS n FROM web GROUP BY day), daily AS (
      SELECT day, user_agent, count(DISTINCT id_orig_h) AS cnt_distinct_hosts,
             count(DISTINCT id_orig_h) / any_value(n) AS ua_norm
      FROM web JOIN totals USING (day) GROUP BY day, user_agent)
    {_extreme_sql('user_agent', AGENT_MEASURES)}""",
)
def fiveday_popularity_ua(t: Tables):
    web = t.web()
    return _extremes(popularity.agent_popularity(web, by=["day"]), "user_agent", AGENT_MEASURES)


@query(
    "fiveday_popularity_uri",
    f"""WITH {PAGES}, {TOKENS},
    totals AS (SELECT day, count(DISTINCT id_orig_h) AS clients, count(*) AS logs FROM tokens GROUP BY day),
    stats AS (
      SELECT day, uri_token, count(DISTINCT id_orig_h) AS c, count(*) AS n,
             count(DISTINCT id_orig_h) / any_value(clients) AS cf, count(*) / any_value(logs) AS nf
      FROM tokens JOIN totals USING (day) GROUP BY day, uri_token),
    daily AS (
      SELECT day, uri, max(c) AS max_cnt_distinct_ip_uri_token, max(n) AS max_cnt_log_uri_token,
             max(cf) AS max_ip_uri_token_freq, max(nf) AS max_log_uri_token_freq
      FROM tokens JOIN stats USING (day, uri_token) GROUP BY day, uri)
    {_extreme_sql('uri', URI_MEASURES)}""",
)
def fiveday_popularity_uri(t: Tables):
    logs = _uri_logs(t)
    return _extremes(popularity.uri_popularity(logs, by=["day"]), "uri", URI_MEASURES)


@query("cnt_resp_ip", f"WITH {WEB} SELECT host, count(DISTINCT id_resp_h) AS \"cnt_IP\" FROM web GROUP BY host")
def cnt_resp_ip(t: Tables):
    return conn_stats.addresses_per_host(t.web())


@query("fqdn_per_ip", f"WITH {WEB} SELECT id_resp_h, count(DISTINCT host) AS cnt_server FROM web GROUP BY id_resp_h")
def fqdn_per_ip(t: Tables):
    return conn_stats.hosts_per_address(t.web())


@query(
    "first_seen_conn",
    f"""WITH {WEB} SELECT uid, id_resp_h, host, min(epoch_us(ts)) AS first_us FROM web GROUP BY uid, id_resp_h, host""",
)
def first_seen_conn(t: Tables):
    first = conn_stats.first_logs(t.web(), ["uid", "id_resp_h", "host"])
    return first.select("uid", "id_resp_h", "host", F.unix_micros("ts").alias("first_us"))
