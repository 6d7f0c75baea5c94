"""Join, label and score queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.functions.scores import is_established
from flowloom.operators import conn_stats, enrich, labels, surprise
from flowloom.plans.queries.bindings import CERT, CHAIN, CONN, SSL, WEB, Tables, query

BAND = 3600.0


def _match_sides(t: Tables):
    """Errors play alerts, half of them with swapped endpoints; all other events play connections."""
    web = t.web().withColumns(
        {
            "a": F.concat(F.lit("c"), F.col("id_orig_h")),
            "b": F.concat(F.lit("r"), F.col("k") % 3),
            "swap": F.col("event_id") % 2 == 1,
        }
    )
    pick = lambda x, y: F.when(F.col("swap"), y).otherwise(x)
    alerts = web.where(F.col("user_agent") == "error").select(
        F.col("event_id").alias("alert_id"),
        pick(F.col("a"), F.col("b")).alias("src"), pick(F.col("b"), F.col("a")).alias("dst"),
        pick(F.lit(1), F.lit(2)).alias("spt"), pick(F.lit(2), F.lit(1)).alias("dpt"),
        pick(F.lit("home"), F.lit("none")).alias("anon_src"), pick(F.lit("none"), F.lit("home")).alias("anon_dst"),
        F.concat(F.date_format("ts", "MMM dd yyyy HH:mm:ss"), F.lit(" UTC")).alias("rt"),
        F.element_at(
            F.array(*[F.lit(n) for n in ("malware-callback", "malware-object", "infection-match", "ips-event", "scan")]),
            (F.col("k") % 5 + 1).cast("int"),
        ).alias("eventName"),
    )
    conns = web.where(F.col("user_agent") != "error").select(
        F.col("event_id").alias("uid"), F.col("a").alias("id_orig_h"), F.col("b").alias("id_resp_h"),
        F.lit(1).alias("id_orig_p"), F.lit(2).alias("id_resp_p"), F.lit("home").alias("anon_orig"),
        F.lit("none").alias("anon_resp"), F.col("ts").cast("double").alias("ts"), "host",
    )
    return alerts, conns


MATCH = f"""{WEB}, matched AS (
  SELECT c.event_id AS uid, a.event_id AS alert_id, c.host,
    CASE a.k % 5 WHEN 0 THEN 'malware-callback' WHEN 1 THEN 'malware-object' WHEN 2 THEN 'infection-match'
                 WHEN 3 THEN 'ips-event' ELSE 'scan' END AS event_name
  FROM web c JOIN web a ON a.id_orig_h = c.id_orig_h AND a.k % 3 = c.k % 3
   AND abs(epoch(c.ts) - epoch(date_trunc('second', a.ts))) <= {BAND}
  WHERE c.user_agent <> 'error' AND a.user_agent = 'error')"""


@query("alert_match", f"WITH {MATCH} SELECT uid, alert_id, host, event_name, CAST(1 AS INTEGER) AS fe_label FROM matched")
def alert_match(t: Tables):
    alerts, conns = _match_sides(t)
    found = enrich.alert_match(alerts, conns, BAND)
    return found.select("uid", "alert_id", "host", F.col("eventName").alias("event_name"), "fe_label")


@query(
    "alert_score",
    f"""WITH {MATCH} SELECT host, CASE event_name WHEN 'malware-callback' THEN CAST(1.0 AS DOUBLE)
      WHEN 'malware-object' THEN CAST(0.01 AS DOUBLE) WHEN 'infection-match' THEN CAST(0.009 AS DOUBLE)
      ELSE CAST(0.008 AS DOUBLE) END AS fe_score FROM matched WHERE event_name <> 'scan'""",
)
def alert_score(t: Tables):
    alerts, conns = _match_sides(t)
    return labels.alert_scores(enrich.alert_match(alerts, conns, BAND))


@query(
    "callback_targets",
    """SELECT DISTINCT url AS request, regexp_extract(url, '^https?://([^/?#]*)', 1) AS fqdn
       FROM pages WHERE starts_with(url, 'https:')""",
)
def callback_targets(t: Tables):
    """Pages play alert requests; the secure ones play callbacks."""
    alerts = t.table("pages").select(
        F.col("url").alias("request"),
        F.when(F.col("url").startswith("https:"), "malware-callback").otherwise("ips-event").alias("eventName"),
    )
    return labels.callback_targets(alerts)


@query(
    "conn_enrich_left",
    f"""WITH {CONN}, {SSL} SELECT s.uid, s.established, s.cipher, c.proto, c.duration, c.conn_state
        FROM ssl s LEFT JOIN conn c USING (uid)""",
)
def conn_enrich_left(t: Tables):
    return enrich.with_connection(t.ssl(), t.conn(), ["proto", "duration", "conn_state"])


@query(
    "conn_http",
    f"""WITH {WEB}, {CONN} SELECT w.uid, w.event_id, w.host, c.proto, c.duration, c.conn_state
        FROM web w LEFT JOIN conn c ON w.uid = c.uid""",
)
def conn_http(t: Tables):
    web = t.web().select("uid", "event_id", "host")
    return enrich.with_connection(web, t.conn(), ["proto", "duration", "conn_state"])


@query(
    "ssh_conn",
    f"""WITH {CONN} SELECT o_orderkey AS uid, o_orderpriority AS client, duration, orig_bytes, resp_bytes, conn_state
        FROM orders LEFT JOIN conn ON o_orderkey = uid""",
)
def ssh_conn(t: Tables):
    """All SSH rows are kept, with the detail of their connection."""
    ssh = t.table("orders").select(F.col("o_orderkey").alias("uid"), F.col("o_orderpriority").alias("client"))
    return enrich.with_connection(ssh, t.conn(), ["duration", "orig_bytes", "resp_bytes", "conn_state"])


@query(
    "rank_lookup",
    f"""WITH {WEB}, ranks AS (SELECT concat('h', n_nationkey, '.example.com') AS host, n_nationkey AS rank FROM nation)
    SELECT host, min(rank) AS cisco1m_index FROM (SELECT DISTINCT host FROM web) LEFT JOIN ranks USING (host)
    GROUP BY host""",
)
def rank_lookup(t: Tables):
    ranks = t.table("nation").select(
        F.concat(F.lit("h"), "n_nationkey", F.lit(".example.com")).alias("host"), F.col("n_nationkey").alias("rank")
    )
    return enrich.rank_lookup(t.web(), ranks)


FEED = """feed AS (SELECT c_custkey AS indicator, c_name, DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS day
  FROM customer)"""


def _sides(t: Tables):
    log = t.web().select("event_id", "day", "id_orig_h", F.col("k").cast("long").alias("id_resp_h"))
    feed = t.table("customer").select(
        F.col("c_custkey").alias("indicator"), "c_name",
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 30).cast("int")).alias("day"),
    )
    return log, feed


def _blacklist_sql(extra: str) -> str:
    cols = "event_id, id_orig_h, CAST(k AS BIGINT) AS id_resp_h, indicator, c_name"
    return f"""WITH {WEB}, {FEED}
    SELECT {cols}, 1 AS "id_orig_h_inHoneypot", 0 AS "id_resp_h_inHoneypot" FROM web w JOIN feed f ON id_orig_h = indicator {extra}
    UNION ALL
    SELECT {cols}, 0, 1 FROM web w JOIN feed f ON k = indicator {extra}"""


@query("blacklist_match", _blacklist_sql(""))
def blacklist_match(t: Tables):
    log, feed = _sides(t)
    return enrich.blacklist_match(log.drop("day"), feed.drop("day"))


@query("blacklist_retro", _blacklist_sql("AND f.day = w.day + 1"))
def blacklist_retro(t: Tables):
    log, feed = _sides(t)
    return enrich.retro_blacklist_match(log, feed, 1).drop("day")


@query("blacklist_retro2", _blacklist_sql("AND f.day = w.day + 2"))
def blacklist_retro2(t: Tables):
    log, feed = _sides(t)
    return enrich.retro_blacklist_match(log, feed, 2).drop("day")


@query(
    "ssh_bf_succ",
    """SELECT l_orderkey AS uid, l_linenumber AS auth_attempts, l_suppkey AS id_resp_h
       FROM lineitem WHERE l_linenumber > 3 AND l_returnflag = 'A'""",
)
def ssh_bf_succ(t: Tables):
    ssh = t.table("lineitem").select(
        F.col("l_orderkey").alias("uid"), F.col("l_linenumber").alias("auth_attempts"),
        F.col("l_suppkey").alias("id_resp_h"), F.when(F.col("l_returnflag") == "A", "1").otherwise("0").alias("auth_success"),
    )
    return enrich.brute_force_success(ssh).drop("auth_success")


@query(
    "ssl_mismatch_label",
    f"""WITH {CONN}, {SSL},
    pairs AS (SELECT c.*, s.uid IS NOT NULL AS has_ssl, s.established = 'T' AS ok
      FROM conn c LEFT JOIN ssl s USING (uid) WHERE id_resp_p = 443 AND conn_state IN ('SF', 'S1'))
    SELECT uid, CAST(ts AS DATE) AS day, 0 AS label FROM conn WHERE id_resp_p <> 443
    UNION ALL
    SELECT uid, CAST(ts AS DATE), CASE
      WHEN has_ssl AND ok THEN 1
      WHEN has_ssl AND EXISTS (FROM pairs q WHERE q.has_ssl AND q.ok AND q.id_orig_h = p.id_orig_h
                               AND q.id_resp_h = p.id_resp_h AND q.id_resp_p = p.id_resp_p) THEN 2
      WHEN has_ssl THEN 3
      WHEN EXISTS (FROM pairs q WHERE q.has_ssl AND q.id_orig_h = p.id_orig_h
                   AND q.id_resp_h = p.id_resp_h AND q.id_resp_p = p.id_resp_p) THEN 4
      ELSE 5 END
    FROM pairs p""",
)
def ssl_mismatch_label(t: Tables):
    labelled = labels.ssl_mismatch_label(t.ssl(), t.conn())
    return labelled.select("uid", F.col("ts").cast("date").alias("day"), "label")


@query(
    "conns_without_ssl",
    f"WITH {CONN}, {SSL} SELECT uid, id_orig_h, id_resp_h, id_resp_p FROM conn c WHERE NOT EXISTS (FROM ssl s WHERE s.uid = c.uid)",
)
def conns_without_ssl(t: Tables):
    return labels.without_partner(t.conn(), t.ssl(), ["uid"]).select("uid", *labels.TUPLE)


@query(
    "conns_with_sibling",
    f"""WITH {CONN}, {SSL}, tls AS (SELECT DISTINCT id_orig_h, id_resp_h, id_resp_p FROM conn JOIN ssl USING (uid))
    SELECT uid, id_orig_h, id_resp_h, id_resp_p FROM conn c
    WHERE NOT EXISTS (FROM ssl s WHERE s.uid = c.uid) AND EXISTS (FROM tls t WHERE t.id_orig_h = c.id_orig_h
      AND t.id_resp_h = c.id_resp_h AND t.id_resp_p = c.id_resp_p)""",
)
def conns_with_sibling(t: Tables):
    tls = labels.with_partner(t.conn(), t.ssl(), ["uid"]).select(*labels.TUPLE)
    alone = labels.without_partner(t.conn(), t.ssl(), ["uid"])
    return labels.with_partner(alone, tls, labels.TUPLE).select("uid", *labels.TUPLE)


@query(
    "tuple_profile",
    f"""WITH {CONN}, {SSL}, marked AS (
      SELECT c.*, s.uid IS NOT NULL AS has_ssl FROM conn c LEFT JOIN (SELECT DISTINCT uid FROM ssl) s USING (uid))
    SELECT id_orig_h, id_resp_h, id_resp_p, count(*) AS conn_count,
      CAST(sum(CAST(has_ssl AS INTEGER)) AS BIGINT) AS ssl_agg_count, round(avg(duration), 6) AS dur_mean,
      round(stddev_samp(duration), 6) AS dur_std, round(sum(orig_bytes), 2) AS sum_orig_bytes,
      CAST(sum(resp_bytes) AS BIGINT) AS sum_resp_bytes,
      round(sum(resp_bytes) / (sum(orig_bytes) + sum(resp_bytes)), 6) AS ratio_responder_to_all_bytes,
      round(avg(CASE WHEN conn_state IN ('SF', 'S1') THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS ratio_established_conn_state,
      round(CASE WHEN sum(CAST(has_ssl AS INTEGER)) = 0 THEN NULL
            ELSE count(*) / sum(CAST(has_ssl AS INTEGER)) END, 6) AS ratio_conn_to_ssl
    FROM marked GROUP BY ALL""",
)
def tuple_profile(t: Tables):
    seen = t.ssl().select("uid").distinct().withColumn("has_ssl", F.lit(True))
    marked = (
        t.conn().join(seen, "uid", "left").fillna(False, ["has_ssl"])
        .withColumn("established_state", is_established("conn_state"))
    )
    out = conn_stats.tuple_profile(marked)
    ratios = ["dur_mean", "dur_std", "ratio_responder_to_all_bytes", "ratio_established_conn_state", "ratio_conn_to_ssl"]
    return out.withColumns({**{c: F.round(c, 6) for c in ratios}, "sum_orig_bytes": F.round("sum_orig_bytes", 2)})


PROFILE_SQL = f"""WITH {CONN}, {CHAIN}, {CERT}, tls AS (
  SELECT o_orderkey AS uid, o_orderpriority NOT LIKE '1%' AS is_tls,
    CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'www.shop.co.uk' WHEN 2 THEN 'promo.example.com' ELSE 'none.example' END AS sni
  FROM orders WHERE o_orderstatus <> 'P'),
facts AS (
  SELECT tls.uid, is_tls, sni, len, cert.id AS cert_id, nvb - to_days(10227) AS nvb, nva - to_days(10227) AS nva, p_size % 6 = 0 AS own,
    sni IN (san1, 'www.shop.co.uk') AS known
  FROM tls LEFT JOIN chain ON chain.uid = tls.uid AND pos = 0 LEFT JOIN cert ON cert.id = cert_id),
marked AS (SELECT c.*, f.uid AS tls_uid, is_tls, sni, len, cert_id, nvb, nva, own, known FROM conn c LEFT JOIN facts f USING (uid)),
main AS (
  SELECT id_orig_h, id_resp_h, id_resp_p, count(*) AS conn_count, count(tls_uid) AS ssl_agg_count, avg(duration) AS m, stddev_samp(duration) AS s,
    round(sum(orig_bytes), 2) AS sum_orig_bytes, CAST(sum(resp_bytes) AS BIGINT) AS sum_resp_bytes,
    CAST(sum(l_linenumber) AS BIGINT) AS sum_orig_pkts, CAST(sum(l_partkey % 10) AS BIGINT) AS sum_resp_pkts,
    round(avg(len), 6) AS mean_cert_fuids, round(avg(date_diff('day', nvb, nva)), 6) AS mean_validity_len,
    round(stddev_samp(date_diff('day', nvb, nva)), 6) AS std_validity_len,
    count(*) FILTER (ts < nvb OR ts > nva) AS num_cert_invalid,
    round(avg((epoch(ts) - epoch(nvb)) / (epoch(nva) - epoch(nvb))), 6) AS ratio_cert_age_valid,
    count(DISTINCT cert_id) AS unique_cert_fuids, CASE WHEN count(cert_id) > 0 THEN CAST(2 AS DOUBLE) END AS mean_num_san_dns_domains,
    round(sum(resp_bytes) / (sum(orig_bytes) + sum(resp_bytes)), 6) AS ratio_responder_to_all_bytes,
    round(avg(CASE WHEN conn_state IN ('SF', 'S1') THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS ratio_established_conn_state,
    round(count(*) / nullif(count(tls_uid), 0), 6) AS ratio_conn_to_ssl,
    round(count(*) FILTER (is_tls) / nullif(count(tls_uid), 0), 6) AS ratio_tls_ssl,
    round(count(*) FILTER (tls_uid IS NOT NULL AND sni IS NULL) / nullif(count(tls_uid), 0), 6) AS ratio_null_sni,
    round(count(*) FILTER (own) / nullif(count(tls_uid), 0), 6) AS ratio_self_signed, bool_and(known) AS all_sni_in_san_dns
  FROM marked GROUP BY ALL),
outside AS (
  SELECT id_orig_h, id_resp_h, id_resp_p,
    round(CASE WHEN any_value(s) IS NOT NULL THEN 100 * count(*) FILTER (abs(duration - m) - s > 1e-9) / count(*) END, 6) AS prcnt_outside_std_dev
  FROM conn JOIN main USING (id_orig_h, id_resp_h, id_resp_p) GROUP BY ALL),
gaps AS (
  SELECT *, epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY id_orig_h, id_resp_h, id_resp_p ORDER BY ts) AS g FROM conn),
period AS (
  SELECT id_orig_h, id_resp_h, id_resp_p, round(avg(g), 3) AS periodicity_mean, round(stddev_samp(g), 3) AS periodicity_std FROM gaps GROUP BY ALL)
SELECT * EXCLUDE (m, s), round(m, 6) AS dur_mean, round(s, 6) AS dur_std
FROM main JOIN outside USING (id_orig_h, id_resp_h, id_resp_p) JOIN period USING (id_orig_h, id_resp_h, id_resp_p)"""


@query("tuple_profile_all", PROFILE_SQL)
def tuple_profile_all(t: Tables):
    """All declared measures; every sixth size of certificate is its own issuer, and certificates are of the time of the logs."""
    uid = F.col("uid") % 4
    names = F.when(uid == 1, "www.shop.co.uk").when(uid == 2, "promo.example.com").when(uid == 3, "none.example")
    ssl = t.ssl().withColumn("version", F.when(F.col("cipher").startswith("1"), "SSLv3").otherwise("TLSv12"))
    ssl = ssl.withColumn("server_name", names).join(t.chains(), "uid", "left")
    earlier = lambda c: F.timestamp_add("DAY", F.lit(-10227), F.col(c))
    cert = t.cert().withColumns({
        "certificate_issuer": F.when(F.col("p_size") % 6 == 0, F.col("certificate_subject")).otherwise(F.col("certificate_issuer")),
        **{c: earlier(c) for c in ("certificate_not_valid_before", "certificate_not_valid_after")},
    })
    conn = t.conn().withColumns({"orig_pkts": F.col("l_linenumber"), "resp_pkts": F.col("l_partkey") % 10})
    out = conn_stats.tls_tuple_profile(conn, conn_stats.tls_facts(ssl, cert))
    exact = {"sum_orig_bytes": F.round("sum_orig_bytes", 2), **{c: F.round(c, 3) for c in ("periodicity_mean", "periodicity_std")}}
    doubles = [f.name for f in out.schema.fields if f.dataType.simpleString() == "double" and f.name not in exact]
    return out.withColumns({**exact, **{c: F.round(c, 6) for c in doubles}})


DISCRETE = """SELECT w.event_id, (ln(total + distinct_n) - ln(cell + 1)) / mean AS score FROM web w
  JOIN (SELECT user_agent, host, count(*) AS cell FROM web GROUP BY ALL) c USING (user_agent, host)
  JOIN (SELECT user_agent, count(*) AS total, count(DISTINCT host) AS distinct_n FROM web GROUP BY ALL) g USING (user_agent)
  JOIN (SELECT user_agent, avg(ln(t2 + d2) - ln(c2 + 1)) AS mean FROM web
        JOIN (SELECT user_agent, host, count(*) AS c2 FROM web GROUP BY ALL) USING (user_agent, host)
        JOIN (SELECT user_agent, count(*) AS t2, count(DISTINCT host) AS d2 FROM web GROUP BY ALL) USING (user_agent)
        GROUP BY user_agent) m USING (user_agent)"""


@query("discrete_score", f"WITH {WEB}, s AS ({DISCRETE}) SELECT event_id, round(score, 6) AS scored_host FROM s")
def discrete_score(t: Tables):
    scored = surprise.discrete_score(t.web(), "host", ["user_agent"])
    return scored.select("event_id", F.round("scored_host", 6).alias("scored_host"))


def _continuous_sql(residual: str) -> str:
    return f"""lines AS (
      SELECT event_id, user_agent, power({residual} - mean, 2) * 0.5 / var + 0.5 * ln(2 * pi() * var) AS ll
      FROM web JOIN (SELECT user_agent, avg(ln(1 + value)) AS mean, var_pop(ln(1 + value)) AS var FROM web GROUP BY ALL)
      USING (user_agent)),
    means AS (SELECT user_agent, avg(ll) AS m FROM lines GROUP BY ALL)"""


@query(
    "continuous_score",
    f"WITH {WEB}, {_continuous_sql('ln(1 + value)')} SELECT event_id, round(ll / m, 6) AS scored_value FROM lines JOIN means USING (user_agent)",
)
def continuous_score(t: Tables):
    scored = surprise.continuous_score(t.web(), "value", ["user_agent"])
    return scored.select("event_id", F.round("scored_value", 6).alias("scored_value"))


@query(
    "continuous_score_raw",
    f"WITH {WEB}, {_continuous_sql('value')} SELECT event_id, round(ll / m, 6) AS scored_value FROM lines JOIN means USING (user_agent)",
)
def continuous_score_raw(t: Tables):
    scored = surprise.continuous_score(t.web(), "value", ["user_agent"], log_residual=False)
    return scored.select("event_id", F.round("scored_value", 6).alias("scored_value"))


@query(
    "group_scores",
    f"""WITH {WEB}, {_continuous_sql('ln(1 + value)')}, s AS ({DISCRETE})
    SELECT event_id, round(score, 6) AS scored_ua_host, round(ll / m, 6) AS scored_ua_value
    FROM s JOIN lines USING (event_id) JOIN means USING (user_agent)""",
)
def group_scores(t: Tables):
    scored = surprise.score_groups(
        t.web(), ["user_agent"], discrete=["host", "user_agent"], continuous=["value"], description="ua_"
    )
    return scored.select(
        "event_id", F.round("scored_ua_host", 6).alias("scored_ua_host"), F.round("scored_ua_value", 6).alias("scored_ua_value")
    )
