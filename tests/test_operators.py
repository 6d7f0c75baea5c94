import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowloom.operators import certs, cleaning, conn_stats, domains, enrich, labels, popularity, surprise, tables
from flowloom.sources import reports


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


# -- tables


def test_concat_on_common_columns_is_order_insensitive(spark):
    a = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    assert rows(tables.concat_common(a, b), "a", "b") == rows(tables.concat_common(b, a), "a", "b") == [(1, "x"), (2, "y")]


def test_trim(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert tables.trim_columns(df, ["b", "a"]).columns == ["a", "b"]
    assert tables.trim_columns(df, ["b"]).columns == ["b"]
    with pytest.raises(ValueError):
        tables.trim_columns(df, ["z"])


def test_top_k_puts_the_score_first(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 9.0)], "host int, score double")
    assert rows(tables.top_k(df, "score", ["host"], k=2)) == [(5.0, 1), (9.0, 3)]


# -- cleaning


def test_clean_log(spark):
    df = spark.createDataFrame(
        [("u", "bad", ["a", "b"], None, None, "10.0.0.1", "151.228.241.9", 7)],
        "uid string, ts string, `conn.uids` array<string>, analyzers array<string>, anon_orig string, "
        "`id.orig_h` string, `id.resp_h` string, `resp bytes` long",
    )
    out = cleaning.clean_log(df)
    r = out.first()
    assert r.ts == 0.0 and r.first_conn_uids == "a" and r.analyzers_len is None and r.anon_orig == "missing"
    assert r.InternalIP == "10.0.0.1" and r.ExternalIP == "151.228.241.9" and r.subnet == -1
    assert "resp_bytes" in out.columns


def test_range_lookup_equals_brute_force(spark):
    top = 2**32 - 1
    ranges = [(0, top, 0), (0, 10, 1), (5, 300, 2), (7, 8, 3), (250, 251, 4), (2**24 + 1, 2**25, 5), (top, top, 6), (9, 9, None)]
    ranges += [(12, 11, 9), (None, 5, 9), (2**17 - 1, 3 * 2**20 + 5, 7)]
    values = [None, -1, 0, 6, 7, 8, 9, 11, 12, 250, 300, 301, 2**17 - 2, 2**17 - 1, 3 * 2**20 + 5, 3 * 2**20 + 6]
    values += [2**24, 2**24 + 1, 2**25, 2**25 + 1, top, top + 1, 7]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    table = spark.createDataFrame(ranges, "low long, high long, idx int")
    want = sorted(
        ((v, max([i for lo, hi, i in ranges if None not in (v, lo, i) and lo <= v <= hi], default=-1)) for v in values), key=str
    )
    assert rows(cleaning.range_lookup(df, "v", table, "low", "high", "idx", "out"), "v", "out") == want


@pytest.mark.parametrize("low, high", [(0, 255), (1, 254), (7, 7), (8, 7), (3, 200), (128, 255)])
def test_blocks_cover_a_range_once(spark, low, high):
    cover = spark.range(1).select(cleaning.prefix_cover(F.lit(low).cast("long"), F.lit(high).cast("long"), 8).alias("b")).first().b
    assert sorted(v for s, p in cover for v in range(p << s, (p + 1) << s)) == list(range(low, high + 1))
    assert len(cover) <= 14


# -- popularity


def test_null_clients_count_in_the_denominator_only(spark):
    df = spark.createDataFrame(
        [("a", None, "1"), ("a", "c1", "1"), ("a", "c1", "1"), ("", "c2", "9"), (None, "c3", "1")],
        "host string, id_orig_h string, id_resp_h string",
    )
    assert rows(popularity.host_popularity(df), "host", "cnt_distinct_hosts", "cnt_logs", "fqdn_norm") == [
        ("a", 1, 2, 1 / 3), ("missing_9", 1, 1, 1 / 3)
    ]


def test_uri_tokens(spark):
    df = spark.createDataFrame(
        [("/", "c1"), ("//", "c1"), ("/a/a/b", "c1"), ("/b", "c2"), (None, "c3")], "uri string, id_orig_h string"
    )
    stats = rows(popularity.uri_token_stats(df), "uri_token", "cnt_distinct_ip_uri_token", "cnt_log_uri_token", "log_uri_token_freq")
    assert stats == [("a", 1, 2, 0.5), ("b", 2, 2, 0.5)]
    assert [r.uri for r in popularity.uri_popularity(df).orderBy("uri").collect()] == ["/a/a/b", "/b"]


def test_trailing_extremes_leave_the_day_out(spark):
    df = spark.createDataFrame([(d, "h", v) for d, v in ((1, 5), (2, 1), (7, 9))], "d int, host string, cnt int")
    daily = df.select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("day"), "host", "cnt")
    out = popularity.trailing_extremes(daily, "host", ["cnt"])
    assert [(r.day.day, r.min5day_cnt, r.max5day_cnt) for r in out.orderBy("day").collect()] == [(3, 5, 5), (8, 1, 1)]


# -- joins


ALERT = "src string, dst string, spt int, dpt int, anon_src string, anon_dst string, rt string, eventName string, _lpp_ver string"
CONN = "id_orig_h string, id_resp_h string, id_orig_p int, id_resp_p int, anon_orig string, anon_resp string, ts double, uid string"


def test_alert_band_and_direction(spark):
    rt = "Jan 01 2024 00:10:00 UTC"  # 1704067800
    alerts = spark.createDataFrame(
        [("a", "b", 1, 2, "x", "y", rt, "e1", "v"), ("b", "a", 2, 1, "y", "x", rt, "e2", "v"), ("a", "b", 1, 2, "x", "y", "junk", "e3", "v")],
        ALERT,
    )
    base = 1704067800.0
    conns = spark.createDataFrame(
        [("a", "b", 1, 2, "x", "y", base + d, f"{d:g}") for d in (-301, -300, 0, 300, 300.5, 301)]
        + [("a", "b", 1, 2, "x", "y", None, "null"), ("a", "b", 1, 2, "x", "y", base, "0")], CONN,
    )
    got = rows(enrich.alert_match(alerts, conns), "uid", "eventName")
    assert got == sorted((u, e) for u in ("-300", "0", "300") for e in ("e1", "e2"))


def test_band_join_equals_brute_force(spark):
    import random

    rng = random.Random(3)
    left = [(rng.choice("kl"), rng.uniform(-50, 50), i) for i in range(200)]
    right = [(rng.choice("kl"), rng.uniform(-50, 50), i) for i in range(200)]
    a = spark.createDataFrame(left, "k string, ts double, i int")
    b = spark.createDataFrame(right, "k string, rt double, j int")
    got = rows(enrich.time_band_join(a, b, ["k"], "ts", "rt", 3.0), "i", "j")
    assert got == sorted(((i, j) for k, t, i in left for m, r, j in right if k == m and abs(t - r) <= 3.0), key=str)


def test_blacklist_row_on_both_sides_occurs_twice(spark):
    log = spark.createDataFrame([("b", "x", 1), ("y", "b", 2), ("b", "b", 3), ("x", "y", 4)], "id_orig_h string, id_resp_h string, n int")
    feed = spark.createDataFrame([("b", "bad")], "indicator string, note string")
    got = rows(enrich.blacklist_match(log, feed), "n", "id_orig_h_inHoneypot", "id_resp_h_inHoneypot", "note")
    assert got == [(1, 1, 0, "bad"), (2, 0, 1, "bad"), (3, 0, 1, "bad"), (3, 1, 0, "bad")]


def test_brute_force_needs_the_success_column(spark):
    df = spark.createDataFrame([(4, "1"), (3, "1"), (9, "0"), (9, None), (5, "true")], "auth_attempts int, auth_success string")
    assert rows(enrich.brute_force_success(df), "auth_attempts") == [(4,), (5,)]
    assert enrich.brute_force_success(df.drop("auth_success")).count() == 0


def test_connection_columns_do_not_clash(spark):
    ssh = spark.createDataFrame([("u", "s"), ("w", "t")], "uid string, service string")
    conn = spark.createDataFrame([("u", "ssh", 1.0)], "uid string, service string, duration double")
    out = enrich.with_connection(ssh, conn, ["service", "duration"])
    assert rows(out, "uid", "service", "conn_service", "duration") == [("u", "s", "ssh", 1.0), ("w", "t", None, None)]


def test_rank_lookup_keeps_one_row_per_host(spark):
    hosts = spark.createDataFrame([("a",), ("a",), ("b",)], "host string")
    ranks = spark.createDataFrame([("a", 7), ("a", 3)], "host string, rank int")
    assert rows(enrich.rank_lookup(hosts, ranks)) == [("a", 3), ("b", None)]


# -- labels


def test_ssl_mismatch_labels(spark):
    conn = spark.createDataFrame(
        [("other", 80, "SF", "a"), ("null", None, "SF", "a"), ("ok", 443, "SF", "a"), ("sib", 443, "S1", "a"),
         ("alone", 443, "RSTO", "b"), ("nossl_sib", 443, "RSTR", "a"), ("nossl", 443, "S2", "c"), ("rst", 443, "RSTOS0", "a"),
         ("rstrh", 443, "RSTRH", "a"), ("odd", 443, "SF", "d")],
        "uid string, id_resp_p int, conn_state string, id_orig_h string",
    ).withColumns({"id_resp_h": F.lit("r"), "ts": F.lit(1.0)})
    ssl = spark.createDataFrame([("ok", "T"), ("sib", "F"), ("alone", "F"), ("odd", None)], "uid string, established string")
    got = dict(rows(labels.ssl_mismatch_label(ssl, conn), "uid", "label"))
    assert got == {"other": 0, "null": 0, "ok": 1, "sib": 2, "alone": 3, "nossl_sib": 4, "nossl": 5}


# -- certificates


def test_chains(spark):
    ssl = spark.createDataFrame(
        [("empty", []), ("null", None), ("one", ["a"]), ("three", ["a", "x", "c"]), ("noleaf", ["x", "c"]), ("noroot", ["c", "x"])],
        "uid string, cert_chain_fuids array<string>",
    )
    x509 = spark.createDataFrame([("a", "A"), ("c", "C")], "id string, certificate_issuer string")
    assert rows(certs.expand_chains(ssl, x509), "uid", "pos", "cert_id") == [
        ("noleaf", 1, "c"), ("noroot", 0, "c"), ("one", 0, "a"), ("three", 0, "a"), ("three", 2, "c")
    ]
    assert rows(certs.leaf_with_root(ssl, x509), "uid", "id", "root_id", "root_certificate_issuer") == [
        ("noroot", "c", None, None), ("one", "a", "a", "A"), ("three", "a", "c", "C")
    ]


def test_split_hosts(spark):
    rules = spark.createDataFrame([("com",), ("uk",), ("co.uk",), ("*.ck",), ("!www.ck",)], "suffix string")
    hosts = ["a.b.Example.com", "example.co.uk", "co.uk", "x.y.z.ck", "www.ck", "a.www.ck", "localhost", "10.0.0.1", "h.unknown"]
    out = domains.split_hosts(spark.createDataFrame([(h,) for h in hosts], "host string"), "host", rules)
    assert {r.host: (r.subdomain, r.domain, r.suffix) for r in out.collect()} == {
        "a.b.Example.com": ("a.b", "Example", "com"), "example.co.uk": ("", "example", "co.uk"), "co.uk": ("", "", "co.uk"),
        "x.y.z.ck": ("x", "y", "z.ck"), "www.ck": ("", "www", "ck"), "a.www.ck": ("a", "www", "ck"),
        "localhost": ("", "localhost", ""), "10.0.0.1": ("", "10.0.0.1", ""), "h.unknown": ("h", "unknown", ""),
    }


def test_registered_domains_of_lists(spark):
    rules = spark.createDataFrame([("com",)], "suffix string")
    df = spark.createDataFrame([(1, ["a.x.com", "b.x.com", "y.com"]), (2, []), (3, None)], "id int, san array<string>")
    out = domains.with_registered_domains(df, "san", rules, "found")
    assert {r.id: r.found for r in out.collect()} == {1: ["x.com", "y.com"], 2: [], 3: []}


def test_inventory_drops_copies(spark):
    x509 = spark.createDataFrame(
        [("1", "CN=i,O=o", "CN=s"), ("1", "CN=i,O=o", "CN=s"), ("1", "CN=i,O=p", "CN=s"), (None, None, None)],
        "certificate_serial string, certificate_issuer string, certificate_subject string",
    ).withColumns({c: F.lit("2020-01-01").cast("timestamp") for c in ("certificate_not_valid_before", "certificate_not_valid_after")})
    out = certs.cert_inventory(x509)
    assert out.count() == 2 and "san_dns_json" not in out.columns


def test_category_priority(spark):
    pairs = spark.createDataFrame([("O=Big Inc,CN=x", "s"), ("CN=no", "s")], "certificate_issuer string, certificate_subject string")
    lists = spark.createDataFrame([("Big", "suspicious"), ("Big", "private")], "issuer_name string, category string")
    out = certs.categorise_issuers(pairs, lists)
    assert rows(out, "parsed_issuer_O", "ca_category") == [("Big", "private"), (None, "other")]


# -- scores


def test_scores_handle_null_and_no_variance(spark):
    df = spark.createDataFrame([("g", "a", 1.0), ("g", "a", 1.0), ("g", None, 1.0), (None, "b", 2.0)], "g string, v string, x double")
    import math

    out = surprise.score_groups(df, ["g"], discrete=["v", "g"], continuous=["x"])
    assert "scored_g" not in out.columns
    raw = {"a": -math.log(3 / 4), None: -math.log(1 / 4)}
    mean = (2 * raw["a"] + raw[None]) / 3
    got = {(r.g, r.v): (r.scored_v, r.scored_x) for r in out.collect()}
    assert got[("g", "a")][0] == pytest.approx(raw["a"] / mean) and got[("g", None)][0] == pytest.approx(raw[None] / mean)
    assert {v[1] for v in got.values()} == {1.0}
    assert got[(None, "b")][0] is None  # ln 1 everywhere: the mean is 0


def test_tuple_profile(spark):
    df = spark.createDataFrame([(1.0, 10, 30, True, True), (3.0, 0, 0, False, False)], "duration double, orig_bytes long, resp_bytes long, established_state boolean, has_ssl boolean")
    r = conn_stats.tuple_profile(df.withColumns({k: F.lit(1) for k in ("id_orig_h", "id_resp_h", "id_resp_p")})).first()
    assert (r.conn_count, r.ssl_agg_count, r.dur_mean, r.ratio_responder_to_all_bytes, r.ratio_conn_to_ssl) == (2, 1, 2.0, 0.75, 2.0)


def profile_input(spark, n=400):
    """Connections of 40 tuples and a hot one, every third without a TLS record, and a certificate for most records."""
    conn = spark.createDataFrame(
        [(i, datetime(2024, 1, 1 + i % 5, i % 24, i % 60), "hot" if i % 3 == 0 else f"o{i % 40}", "r" if i % 7 else None, 443, float(i % 6), 10.0, i % 9, 1, 2, "SF" if i % 2 else "REJ") for i in range(n)],
        "uid long, ts timestamp, id_orig_h string, id_resp_h string, id_resp_p int, duration double, orig_bytes double, resp_bytes long, orig_pkts long, resp_pkts long, conn_state string")
    ssl = spark.createDataFrame(
        [(i, "TLSv12" if i % 4 else "SSLv3", f"n{i % 3}" if i % 5 else None, [f"c{i % 11}", "root"]) for i in range(n) if i % 3 != 1],
        "uid long, version string, server_name string, cert_chain_fuids array<string>")
    x509 = spark.createDataFrame(
        [(f"c{i}", f"i{i % 2}", "i0", datetime(2024, 1, 1), datetime(2024, 1, 3 + i), [f"n{i % 3}"]) for i in range(10)],
        "id string, certificate_issuer string, certificate_subject string, certificate_not_valid_before timestamp, certificate_not_valid_after timestamp, san_dns array<string>")
    return conn, ssl, x509


def test_profile_without_tls_and_with_null_keys(spark):
    conn, ssl, x509 = profile_input(spark)
    got = {(r.id_orig_h, r.id_resp_h): r for r in conn_stats.tls_tuple_profile(conn, conn_stats.tls_facts(ssl, x509)).collect()}
    lines = [(r.uid, (r.id_orig_h, r.id_resp_h)) for r in conn.collect()]
    for key, r in got.items():
        uids = [u for u, k in lines if k == key]
        tls = [u for u in uids if u % 3 != 1]
        assert (r.conn_count, r.ssl_agg_count, r.unique_cert_fuids) == (len(uids), len(tls), len({u % 11 for u in tls}))
        assert r.ratio_conn_to_ssl == (len(uids) / len(tls) if tls else None)
        assert r.ratio_null_sni == (sum(u % 5 == 0 for u in tls) / len(tls) if tls else None)
    assert len(got) == len({k for _, k in lines}) and ("hot", None) in got
    bare = conn_stats.tls_tuple_profile(conn, conn_stats.tls_facts(ssl.where("false"), x509)).where("id_orig_h = 'hot' AND id_resp_h = 'r'").first()
    assert (bare.ssl_agg_count, bare.num_cert_invalid, bare.unique_cert_fuids, bare.ratio_tls_ssl, bare.mean_cert_fuids) == (0, 0, 0, None, None)


def test_profile_tasks_grow_with_the_connections(spark, monkeypatch):
    """The parts of a profile meet in tasks of so many connections, whatever the number of shuffle partitions is."""
    conn, ssl, x509 = profile_input(spark)
    plain = lambda df: {tuple(f"{x:.9f}" if isinstance(x, float) else x for x in r) for r in df.collect()}
    few = plain(conn_stats.tls_tuple_profile(conn, conn_stats.tls_facts(ssl, x509)))
    monkeypatch.setattr(conn_stats, "TASK_ROWS", 20, raising=False)
    many = conn_stats.tls_tuple_profile(conn, conn_stats.tls_facts(ssl, x509))
    assert many.rdd.getNumPartitions() == 20 > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert plain(many) == few


def test_connections_of_a_profile_move_twice(spark):
    """To the TLS records, which move too, and from there and from the log to the task of their key."""
    conn, ssl, x509 = profile_input(spark)
    facts = conn_stats.tls_facts(ssl, x509)
    facts = spark.createDataFrame(facts.collect(), facts.schema)
    plan = conn_stats.tls_tuple_profile(conn, facts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == plan.count("Exchange hashpartitioning") == 4


def test_passes_have_every_hash_once():
    sizes = {h: 10 + h % 7 for h in range(0, 3000, 3)} | {30: 900_000, 2000: 400_000, 2001: 300_000}
    passes = conn_stats.key_passes(sizes)
    assert sorted(h for group, _, _ in passes for h in group) == sorted(sizes)
    assert [sum(sizes[h] for h in group) for group, _, _ in passes] == [n for _, n, _ in passes]
    assert {h for group, _, hot in passes if hot for h in group} == {30, 2000, 2001}
    assert conn_stats.key_passes({}) == [] and len(conn_stats.key_passes({h: 9_000 for h in range(16_384)})) == conn_stats.PASSES


def shuffles(spark):
    """Shuffles that have files on the disk."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {n.split("_")[1] for d in folders for _, _, names in os.walk(d) for n in names if n.startswith("shuffle_")}


def test_profile_in_passes_leaves_no_shuffles(spark, monkeypatch):
    """The rows of many connections come by passes, hot keys by themselves, and the disk keeps only the parts that are ready."""
    conn, ssl, x509 = profile_input(spark, 900)
    more = [(None, None, "hot", None, None, None, None, None, None, None, None), (7, None, "o7", "r", 443, 2.5, None, 3, None, 1, "SF")]
    conn = conn.union(spark.createDataFrame(more, conn.schema))
    plain = lambda df: sorted(str([f"{x:.9f}" if isinstance(x, float) else x for x in r]) for r in df.collect())
    one = plain(conn_stats.tls_tuple_profile(conn, conn_stats.tls_facts(ssl, x509)))
    assert len(one) == conn.select(*conn_stats.TUPLE).distinct().count()
    for name, value in {"PASS_ROWS": 150, "HOT_ROWS": 60, "KEY_HASHES": 64, "TASK_ROWS": 40}.items():
        monkeypatch.setattr(conn_stats, name, value, raising=False)
    before = shuffles(spark)
    many = conn_stats.tls_tuple_profile(conn, conn_stats.tls_facts(ssl, x509))
    assert len(many.inputFiles()) > 3 and "Exchange" not in many._jdf.queryExecution().executedPlan().toString()
    assert len(shuffles(spark) - before) <= 2  # of the two counts
    assert plain(many) == one
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


# -- reports


LINES = [
    "{'query': 'a.com', 'query_date': '2020-01-01', 'positives': 1, 'total': 2, 'scans': {'X Lab!': {'detected': True, 'result': 'None, it said'}, 'Y': {'detected': False, 'result': None}}}",
    "{'query': 'a.com', 'query_date': '2020-01-02', 'positives': 1, 'total': 2, 'scans': {'X Lab!': {'detected': True, 'result': \"it's\"}}}",
    "{'query': 'b.com', 'query_date': '2020-01-02', 'positives': 0, 'total': 2, 'scans': {'Y': {'detected': False, 'result': None}}}",
    "{'query': 'c.com', 'query_date': '2020-01-02', 'positives': None, 'total': 2, 'scans': {'Y': {'detected': True, 'result': 'z'}}}",
    "{'query': 'd.com', 'scans': None}", "not a report", "{'query': 'e.com', 'scans': {'Y': {'result': 'q'}}}",
]


def test_reports(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    wide = reports.pivot_verdicts(reports.parse_reports(lines))
    assert wide.columns == ["fqdn", "date", "positives", "total", "xlab_detected", "xlab_result", "y_detected", "y_result"]
    assert rows(wide, "fqdn", "xlab_detected", "xlab_result", "y_detected", "y_result") == sorted(
        [("a.com", 1, "None, it said", 0, "None"), ("a.com", 1, "it's", None, None), ("b.com", None, None, 0, "None"),
         ("c.com", None, None, 1, "z")], key=str)
    assert rows(reports.parse_reports(lines, strict=True), "fqdn", "date") == [("a.com", "2020-01-01")]


def test_sections_without_detections_are_zero(spark):
    df = spark.createDataFrame([("s", 1, 4), ("s", 2, 4), ("t", None, 5)], "k string, positives int, total int")
    assert rows(reports.section_average(df, ["k"])) == [("s", 1.5, 4.0), ("t", 0.0, 0.0)]


def test_a_hot_key_keeps_results_whole(spark):
    """A third of the rows under one host, in many small partitions."""
    rows_in = [("hot" if i % 3 == 0 else f"h{i % 50}", f"c{i % 97}", "1.1.1.1", float(i)) for i in range(6000)]
    df = spark.createDataFrame(rows_in, "host string, id_orig_h string, id_resp_h string, ts double").repartition(12)
    got = {r.host: (r.cnt_distinct_hosts, r.cnt_logs) for r in popularity.host_popularity(df).collect()}
    clients, logs = {}, {}
    for h, c, _, _ in rows_in:
        clients.setdefault(h, set()).add(c)
        logs[h] = logs.get(h, 0) + 1
    assert got == {h: (len(clients[h]), logs[h]) for h in logs}
    kept = {r.host: r.ts for r in tables.keep_one(df, ["host"], ["ts"]).collect()}
    assert kept == {h: min(t for x, _, _, t in rows_in if x == h) for h in logs}
    alerts = df.where("ts % 500 = 0").select("host", F.col("ts").alias("rt"), F.col("ts").alias("a"))
    pairs = enrich.time_band_join(df, alerts, ["host"], "ts", "rt", 6.0)
    want = [(h, t, a) for h, _, _, t in rows_in for g, _, _, a in rows_in if a % 500 == 0 and g == h and abs(t - a) <= 6]
    assert rows(pairs, "host", "ts", "a") == sorted(want, key=str)
