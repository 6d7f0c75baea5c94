"""The registered tables: 17 raw logs and feeds, 59 derived tables.

A name ending in ``_vt`` reads the second site's copy of a log.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from flowloom.operators import certs, conn_stats, domains, enrich, history, labels, periodicity, popularity, series
from flowloom.plans.registry import EMPTY, ERROR, PARTIAL, SKIP, Feature, Input, Registry
from flowloom.plans.slots import DAY, HALF_HOUR, MONTH, YEAR
from flowloom.sources.feeds import CsvLoader
from flowloom.sources.logs import AlertLoader, LogLoader
from flowloom.sources.reports import ReportLoader

SLOT = "slot_start"
BY = (SLOT,)

# Raw logs per half hour, those kept once read and those not.
KEPT_LOGS = ("dns", "files", "irc", "ssh", "x509", "ssl", "http", "ssl_vt", "conn_vt", "http_vt")
PASSING_LOGS = ("conn_long", "conn")

# Columns of the certificate and TLS logs that the chain feature reads.
X509_COLUMNS = (
    "id", "basic_constraints_ca", "basic_constraints_path_len", "certificate_issuer", "certificate_curve",
    "certificate_exponent", "certificate_not_valid_after", "certificate_not_valid_before", "certificate_subject",
    "certificate_key_length", "certificate_key_alg", "ts", "san_dns_len", "san_dns", "certificate_version",
    "certificate_sig_alg", "certificate_key_type", "certificate_serial",
)
SSL_COLUMNS = (
    "uid", "anon_orig", "cert_chain_fuids", "cipher", "client_cert_chain_fuids", "client_issuer", "client_subject",
    "first_cert_chain_fuids", "curve", "established", "id_orig_h", "id_orig_p", "id_resp_h", "id_resp_p", "issuer",
    "subject", "ja3", "ja3s", "last_alert", "next_protocol", "resumed", "server_name", "validation_status",
    "version", "cert_chain_fuids_len", "client_cert_chain_fuids_len",
)
MATCH_COLUMNS = ("id_orig_h", "id_resp_h", "id_orig_p", "id_resp_p", "anon_orig", "anon_resp", "ts", "uid")


def build_registry(every_column: bool = True) -> Registry:
    """A registry with every feature; add further ones with its decorator. ``every_column`` is that of the log loaders."""
    reg = Registry()
    _raw(reg, every_column)
    _popularity(reg)
    _counts(reg)
    _matches(reg)
    _certificates(reg)
    _series(reg)
    _histories(reg)
    return reg


def _raw(reg: Registry, every_column: bool) -> None:
    for name in KEPT_LOGS + PASSING_LOGS:
        reg.add(Feature(name, HALF_HOUR, loader=LogLoader(name, every_column=every_column), memoize=name in KEPT_LOGS))
    reg.add(Feature("renisac", DAY, loader=CsvLoader("renisac"), memoize=True))
    reg.add(Feature("honeypot", DAY, loader=CsvLoader("honeypot")))
    reg.add(Feature("fireeye", DAY, loader=AlertLoader("fireeye", every_column=every_column), memoize=True))
    reg.add(Feature("virustotal", YEAR, loader=ReportLoader("virustotal"), memoize=True))
    reg.add(Feature("virustotal_cache", MONTH, loader=CsvLoader("virustotal_cache"), memoize=True))


def _daily(reg: Registry, name: str, inputs, compute, timescale=DAY, memoize=True, carry=False, description=""):
    reg.add(Feature(name, timescale, tuple(inputs), compute, memoize=memoize, carry=carry, description=description))


def _log(name: str, *columns: str, on_missing: str = SKIP) -> Input:
    return Input(name, tuple(columns) or None, on_missing=on_missing)


def _days_before(name: str, days: int = 5):
    return [Input(name, offset=timedelta(days=-i - 1), on_missing=PARTIAL) for i in range(days)]


def _popularity(reg: Registry) -> None:
    for site in ("", "_vt"):
        ends = ("id_orig_h", "id_resp_h")
        _daily(reg, f"popularity_host{site}", [_log(f"http{site}", "host", *ends)],
               lambda ctx, http: popularity.host_popularity(http, "host", by=BY),
               description="Clients and logs per host")
        _daily(reg, f"ssl_popularity_host{site}", [_log(f"ssl{site}", "server_name", *ends)],
               lambda ctx, ssl: popularity.host_popularity(ssl, "server_name", by=BY))
        _daily(reg, f"httpssl_popularity_host{site}",
               [_log(f"ssl{site}", "server_name", *ends, on_missing=EMPTY), _log(f"http{site}", "host", *ends, on_missing=EMPTY)],
               lambda ctx, ssl, http: popularity.multi_host_popularity(
                   (ssl, "server_name"), (http, "host"), by=BY))
    _daily(reg, "popularity_ua", [_log("http", "id_orig_h", "user_agent")],
           lambda ctx, http: popularity.agent_popularity(http, by=BY))
    _daily(reg, "popularity_uri", [_log("http", "id_orig_h", "uri")],
           lambda ctx, http: popularity.uri_popularity(http, by=BY))
    for name, key, measures in (
        ("popularity_host", "host", popularity.HOST_MEASURES),
        ("popularity_ua", "user_agent", popularity.AGENT_MEASURES),
        ("popularity_uri", "uri", popularity.URI_MEASURES),
    ):
        _daily(reg, f"fiveday_{name}", _days_before(name), _five_days(key, measures))


def _five_days(key, measures):
    def compute(ctx, *days):
        return popularity.extremes(popularity.concat_common(*days), [SLOT, key], measures)

    return compute


def _counts(reg: Registry) -> None:
    for prefix, site in (("", ""), ("vt_", "_vt")):
        for log, host in (("http", "host"), ("ssl", "server_name")):
            inputs = [_log(f"{log}{site}", host, "id_resp_h", "uid")]
            _daily(reg, f"{prefix}{log}_cnt_respIP", inputs, _addresses(host))
            _daily(reg, f"{prefix}{log}_fqdn_perIP", inputs, _hosts(host))
    for log in ("ssl", "http"):
        _daily(reg, f"conn_{log}", [_log(log), _log("conn", "uid", *enrich.CONN_SUMMARY, on_missing=EMPTY)],
               lambda ctx, rows, conn: enrich.with_connection(rows, conn, enrich.CONN_SUMMARY, on=BY),
               HALF_HOUR)
    _daily(reg, "ssh_conn", [_log("ssh"), _log("conn", "uid", *enrich.SSH_CONN_COLUMNS)],
           lambda ctx, ssh, conn: enrich.with_connection(ssh, conn, enrich.SSH_CONN_COLUMNS, on=BY),
           HALF_HOUR, description="SSH logs with the detail of their connection")
    _daily(reg, "cisco1m", [_log("http", "host")], _ranks)


def _addresses(host):
    return lambda ctx, log: conn_stats.addresses_per_host(log, host, by=BY)


def _hosts(host):
    return lambda ctx, log: conn_stats.hosts_per_address(log, host, by=BY)


def _ranks(ctx, http):
    ranks = ctx.table("rank_list").groupBy("host").agg(F.min("rank").alias("cisco1m_index"))
    return http.select(SLOT, "host").distinct().join(ranks, "host", "left")


def _matches(reg: Registry) -> None:
    def match(ctx, alerts, log):
        return enrich.alert_match(alerts, log, ctx.settings.match_band, on=BY)

    _daily(reg, "http_fireeye_match", [_log("fireeye"), _log("http", *MATCH_COLUMNS, "host")], match)
    _daily(reg, "ssl_fireeye_match", [_log("fireeye"), _log("ssl", *MATCH_COLUMNS, "server_name")], match)
    for name, scale in (("fireeye_score_v1", MONTH), ("fireeye_score_v2", DAY)):
        _daily(reg, name, [_log("http_fireeye_match", "host", "eventName")],
               lambda ctx, matches: labels.alert_scores(matches, by=BY), scale)
    _daily(reg, "fireeye_MCBL_v1", [Input("fireeye", on_missing=ERROR)],
           lambda ctx, alerts: labels.callback_targets(alerts, by=BY),
           description="Requests of malware callbacks with their host")
    _daily(reg, "ssh_bf_succ", [_log("ssh")], lambda ctx, ssh: enrich.brute_force_success(ssh),
           description="SSH sessions that got in after many attempts")

    def listed(ctx, ssh, feed):
        return enrich.blacklist_match(ssh, feed, on=[SLOT])

    for suffix, days, kept in (("", 0, True), ("_retro1", 1, True), ("_retro2", 2, False)):
        _daily(reg, f"ssh_bf_succ_honeypot{suffix}",
               [_log("ssh_bf_succ"), Input("honeypot", offset=timedelta(days=days), on_missing=ERROR)],
               listed, memoize=kept)
    _daily(reg, "ssl_mismatch_label", [Input("ssl"), Input("conn")],
           lambda ctx, ssl, conn: labels.ssl_mismatch_label(ssl, conn, by=BY), HALF_HOUR)


def _certificates(reg: Registry) -> None:
    _daily(reg, "x509dailycert", [_log("x509")], lambda ctx, x509: certs.cert_inventory(x509, by=BY))

    def chains(ctx, x509, ssl):
        seen = x509.withColumn("ts", F.timestamp_micros(F.round(F.col("ts") * 1000000).cast("long")))
        known = domains.with_registered_domains(
            certs.with_validity(seen).drop("ts"), "san_dns", ctx.table("public_suffixes")
        )
        home = ssl.where(F.col("anon_orig") == ctx.settings.home_site).drop("anon_orig")
        return certs.leaf_with_root(home, known, on=BY)

    _daily(reg, "pre_process", [_log("x509", *X509_COLUMNS), _log("ssl", *SSL_COLUMNS)], chains, HALF_HOUR)
    _daily(reg, "ca_categorize_v2", [_log("pre_process")],
           lambda ctx, pairs: certs.categorise_issuers(pairs, ctx.table("ca_issuers"), by=BY))
    _daily(reg, "find_ca", [_log("ssl")],
           lambda ctx, ssl: certs.issuer_ranking(ssl, ctx.settings.home_site, by=BY),
           description="Issuing organisations of the validated servers a site talks to")


def _series(reg: Registry) -> None:
    def build(host):
        def compute(ctx, log):
            timed = log.withColumn("ts", F.timestamp_micros(F.round(F.col("ts") * 1000000).cast("long")))
            return series.build_series(timed, host, day=SLOT, zone=ctx.settings.zone)

        return compute

    for name, log, host in (
        ("http_ts", "http", "host"), ("http_ts_vt", "http_vt", "host"), ("ssl_ts", "ssl", "server_name"),
        ("ssl_ts_tmp", "ssl", "server_name"), ("ssl_ts_vt", "ssl_vt", "server_name"),
    ):
        _daily(reg, name, [_log(log, "uid", "ts", "id_resp_h", host)], build(host))

    def merge(ctx, http, ssl):
        return series.merge_protocols(http, ssl.withColumnRenamed("server_name", "host"), [SLOT, "host"])

    for site in ("", "_vt"):
        _daily(reg, f"httpssl_ts{site}",
               [_log(f"http_ts{site}", on_missing=EMPTY), _log(f"ssl_ts{site}", on_missing=EMPTY)], merge)

    def detect(host):
        return lambda ctx, ts: periodicity.detect_periodicity(ts)

    def detect_both(host):
        def compute(ctx, here, there):
            return periodicity.detect_periodicity(series.merge_sites(here, there, [SLOT, host]))

        return compute

    for log, host in (("http", "host"), ("ssl", "server_name"), ("httpssl", "host")):
        for site in ("", "_vt"):
            _daily(reg, f"{log}_periodicity{site}", [Input(f"{log}_ts{site}")], detect(host))
        _daily(reg, f"{log}_periodicity_agg", [Input(f"{log}_ts"), Input(f"{log}_ts_vt")], detect_both(host))


def _histories(reg: Registry) -> None:
    day_before = timedelta(days=-1)

    def domain(host, site, kind):
        def compute(ctx, before, log):
            keys = [host, site]
            today = history.daily_hosts(log, host, site, by=[SLOT])
            return continued(ctx, before, today, keys, kind)

        return compute

    def continued(ctx, before, seen, keys, kind):
        """All the slots' histories in one plan, from the state before the first of them."""
        if before is None:
            before = history.empty_history(ctx.spark, keys, log_types=kind is not None)
        dated = seen.select(F.col(SLOT).cast("date").alias("_day"), *keys)
        days = [start.date() for start, _ in ctx.slots]
        done = history.history_continued(before.drop(SLOT), dated, days, keys, "_day", kind, ctx.settings.expiry_days)
        return done.withColumn(SLOT, F.col("_day").cast("timestamp")).drop("_day")

    for name, log, host, site, kind in (
        ("http_domain_history", "http", "host", "anon_host", "HTTP"),
        ("http_domain_history_vt", "http_vt", "host", "anon_host", "HTTP"),
        ("ssl_domain_history", "ssl", "server_name", "anon_resp", "SSL"),
        ("ssl_domain_history_vt", "ssl_vt", "server_name", "anon_resp", "SSL"),
    ):
        inputs = [Input(name, offset=day_before), _log(log, host, "id_resp_h", site, on_missing=EMPTY)]
        _daily(reg, name, inputs, domain(host, site, kind), carry=True)

    def periodic(ctx, before, found):
        return continued(ctx, before, found.where(F.size("true_periods") > 0).select(SLOT, "host"), ["host"], None)

    for log in ("http", "httpssl"):
        name = f"{log}_periodicity_hist"
        inputs = [Input(name, offset=day_before), _log(f"{log}_periodicity", "host", "true_periods", on_missing=EMPTY)]
        _daily(reg, name, inputs, periodic, carry=True)
