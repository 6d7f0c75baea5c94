"""Slots, the store, resolution over real log files, and the shape of plans."""

import gzip
import json
from datetime import datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowloom.plans import slots
from flowloom.plans.catalog import build_registry
from flowloom.plans.queries import QUERIES
from flowloom.plans.registry import Feature, Input, MissingInput, Registry
from flowloom.plans.resolve import Resolver, Settings, store_root
from flowloom.plans.slots import DAY, HALF_HOUR, MONTH, YEAR, is_slot, tile
from flowloom.plans.store import SlotStore

D = datetime(2024, 1, 1)


# -- slots


@given(st.integers(0, 10_000), st.integers(1, 300), st.sampled_from([HALF_HOUR, slots.HOUR, slots.EIGHT_HOURS, DAY]))
def test_tiles_cover_the_range(first, count, step):
    start = datetime(2020, 1, 1) + first * step
    tiles = tile(start, start + count * step, step)
    assert len(tiles) == count and tiles[0][0] == start and tiles[-1][1] == start + count * step
    assert all(a[1] == b[0] for a, b in zip(tiles, tiles[1:])) and all(is_slot(*t, step) for t in tiles)


def test_short_and_misaligned_ranges():
    at = lambda *a: datetime(2024, 1, *a)
    assert tile(at(1, 0, 10), at(1, 0, 20), HALF_HOUR) == [(at(1), at(1, 0, 30))]
    assert tile(at(1, 23, 40), at(2), HALF_HOUR) == [(at(1, 23, 30), at(2))]
    assert tile(at(1, 5), at(1, 6), DAY) == [(at(1), at(2))]
    for start, end in ((at(1, 0, 20), at(1, 0, 40)), (at(1, 0, 10), at(1, 1, 10)), (at(1, 23, 50), at(2, 0, 10)), (at(2), at(1))):
        with pytest.raises(ValueError):
            tile(start, end, HALF_HOUR)
    assert not is_slot(at(1, 0, 10), at(1, 0, 40), HALF_HOUR)


def test_calendar_tiles():
    assert tile(datetime(2024, 2, 3), datetime(2024, 2, 5), MONTH) == [(datetime(2024, 2, 1), datetime(2024, 3, 1))]
    assert tile(datetime(2023, 12, 5), datetime(2024, 1, 1), MONTH) == [(datetime(2023, 12, 1), datetime(2024, 1, 1))]
    assert len(tile(datetime(2023, 11, 1), datetime(2024, 11, 1), MONTH)) == 12  # same month, another year
    with pytest.raises(ValueError):
        tile(datetime(2024, 1, 1), datetime(2024, 2, 2), MONTH)
    with pytest.raises(ValueError):
        tile(datetime(2024, 1, 15), datetime(2024, 4, 20), MONTH)
    assert tile(datetime(2023, 3, 1), datetime(2023, 4, 1), YEAR) == [(datetime(2023, 1, 1), datetime(2024, 1, 1))]
    with pytest.raises(ValueError):
        tile(D, datetime(2024, 2, 1), "week")


# -- registry


def test_registry():
    reg = build_registry()
    assert len(reg.entries) == 76 and sum(f.loader is not None for f in reg.entries.values()) == 17
    assert reg.closure(["fiveday_popularity_ua"]) == ["http", "popularity_ua", "fiveday_popularity_ua"]
    assert reg.closure(["http_domain_history"]) == ["http", "http_domain_history"]
    with pytest.raises(ValueError):
        reg.add(reg["http"])
    with pytest.raises(KeyError):
        reg["nothing"]
    assert reg["http"].also(memoize=False).memoize is False


# -- store


def test_store_overwrites_appends_and_keeps_empty_slots(spark, tmp_path):
    store = SlotStore(spark, str(tmp_path))
    days = [(D + i * DAY, D + (i + 1) * DAY) for i in range(3)]
    rows = [(d[0].strftime("%Y-%m-%d"), i) for i, d in enumerate(days[:2])]
    df = spark.createDataFrame(rows, "d string, n int").select(F.col("d").cast("timestamp").alias("slot_start"), "n")
    store.write("f", df, days)
    store.write("f", df, days[:2])
    assert store.present("f", days) == set(days)
    assert sorted(r.n for r in store.read("f", days, ["n"]).collect()) == [0, 1]
    assert store.read("f", days[2:]).count() == 0 and store.read("f", [(D - DAY, D)]) is None
    store.append("f", df.withColumn("extra", F.lit("x")), days[:1])
    assert {(r.n, r.extra) for r in store.read("f", days[:1]).collect()} == {(0, None), (0, "x")}
    store.append_moment("f", spark.createDataFrame([(7,)], "n int"), D + HALF_HOUR, D + 2 * HALF_HOUR, DAY)
    assert sorted(r.n for r in store.read("f", days[:1]).collect()) == [0, 0, 7]
    assert store.describe("f", days[1])["columns"][0] == "n"
    assert store.slots_of("f") == days


def test_slot_reads_prune_partitions_and_columns(spark, tmp_path):
    store = SlotStore(spark, str(tmp_path))
    days = [(D + i * DAY, D + (i + 1) * DAY) for i in range(3)]
    df = spark.range(30).select((F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.col("id") % 3)).alias("slot_start"),
                                F.col("id").alias("n"), F.lit("w").alias("wide"))
    store.write("f", df, days)
    plan = store.read("f", days[:1], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<n:bigint>" in plan
    assert store.read("f", days[:1]).count() == 10


# -- resolution over files


def put(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)


def put_log(root, kind, start, rows):
    end = start + HALF_HOUR
    put(root / kind / f"{start:%Y-%m-%d}" / f"anon.{kind}_{start:%Y%m%d}_{start:%H%M}-{end:%H%M}.log.gz", rows)


def http(uid, ts, client, host, **more):
    row = {"uid": uid, "ts": slots.epoch(ts), "id.orig_h": client, "id.resp_h": "10.1.1.1", "id.orig_p": 1, "id.resp_p": 80,
           "host": host, "anon_orig": "home", "anon_resp": "none", "anon_host": "t", "uri": "/a/b", "user_agent": "ua"}
    return {**row, **more}


@pytest.fixture
def site(tmp_path):
    root = tmp_path / "raw"
    for day in range(7):
        for half in (0, 12, 47):
            at = D + day * DAY + half * HALF_HOUR
            put_log(root, "http", at, [http(f"u{day}{half}", at, f"c{half}", "h.com"), http(f"v{day}{half}", at, "c0", "")])
    return root


def test_popularity_over_files(spark, site):
    resolver = Resolver(spark, build_registry(), str(site))
    with pytest.raises(MissingInput) as problem:
        resolver.get("http", D, D + DAY)
    assert len(problem.value.paths) == 45
    assert resolver.get("http", D, D + DAY, ["host"], allow_missing=True).count() == 6
    out = resolver.get("popularity_host", D, D + 2 * DAY, keep_slot=True)
    assert sorted((str(r.slot_start)[:10], r.host, r.cnt_distinct_hosts, r.cnt_logs, round(r.fqdn_norm, 3)) for r in out.collect()) == [
        ("2024-01-01", "h.com", 3, 3, 1.0), ("2024-01-01", "missing_10.1.1.1", 1, 3, 0.333),
        ("2024-01-02", "h.com", 3, 3, 1.0), ("2024-01-02", "missing_10.1.1.1", 1, 3, 0.333),
    ]
    assert resolver.load_available("popularity_host", D, D + 5 * DAY).count() == 4
    assert [there for _, there in resolver.status("popularity_host", D, D + 3 * DAY)] == [True, True, False]


def test_five_days_need_all_days(spark, site):
    resolver = Resolver(spark, build_registry(), str(site))
    out = resolver.get("fiveday_popularity_ua", D + 5 * DAY, D + 6 * DAY)
    assert [(r.user_agent, r.min5day_cnt_distinct_hosts) for r in out.collect()] == [("ua", 3)]
    # Two of the five days before have logs, the others no table: what is there counts.
    out = resolver.get("fiveday_popularity_ua", D + 2 * DAY, D + 3 * DAY)
    assert [(r.user_agent, r.max5day_cnt_distinct_hosts) for r in out.collect()] == [("ua", 3)]
    # A day before without logs has no popularity at all, so nothing is missing by name; the table is empty.
    early = resolver.get("popularity_host", D - DAY, D)
    assert early.count() == 0 and "fqdn_norm" in early.columns


def test_history_is_carried_over_a_day_without_logs(spark, tmp_path):
    root = tmp_path / "raw"
    for day in (0, 1, 3):
        put_log(root, "http", D + day * DAY, [http("u", D + day * DAY, "c", f"h{day % 2}.com")])
    resolver = Resolver(spark, build_registry(), str(root), settings=Settings(seed="empty"))
    out = resolver.get("http_domain_history", D, D + 4 * DAY, keep_slot=True)
    got = sorted((r.slot_start.day, r.host, r.count_since_firstseen, r.days_since_lastseen) for r in out.collect())
    assert got == [(1, "h0.com", 1, 0), (2, "h0.com", 1, 1), (2, "h1.com", 1, 0), (3, "h0.com", 1, 1), (3, "h1.com", 1, 0),
                   (4, "h0.com", 1, 3), (4, "h1.com", 2, 0)]


def test_history_never_restarts_silently(spark, tmp_path):
    root = tmp_path / "raw"
    for day in range(4):
        put_log(root, "http", D + day * DAY, [http("u", D + day * DAY, "c", "h.com")])
    strict = Resolver(spark, build_registry(), str(root))
    with pytest.raises(ValueError, match="no stored slot before"):
        strict.get("http_domain_history", D, D + 2 * DAY)
    Resolver(spark, build_registry(), str(root), settings=Settings(seed="empty")).get("http_domain_history", D, D + 2 * DAY)
    last = strict.get("http_domain_history", D + 3 * DAY, D + 4 * DAY).collect()  # the third day is computed on the way
    assert [(str(r.firstseen_date), r.count_since_firstseen) for r in last] == [("2024-01-01", 4)]


def test_feeds_by_their_own_headers_and_rank_list_by_file_order(spark, tmp_path):
    from flowloom.sources.feeds import read_rank_list, scan_csv

    (tmp_path / "a.csv").write_text("indicator,description\n1.1.1.1,bad\n")
    (tmp_path / "b.csv").write_text("description,indicator,extra\nworse,2.2.2.2,x\n")
    rows = scan_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], "indicator string, description string").collect()
    assert sorted((r.indicator, r.description) for r in rows) == [("1.1.1.1", "bad"), ("2.2.2.2", "worse")]
    ranks = tmp_path / "ranks"
    ranks.mkdir()
    (ranks / "part-0.csv").write_text("host\ntop0\ntop1\n")
    (ranks / "part-1.csv").write_text("host\n" + "".join(f"low{i}\n" for i in range(500)))
    got = {r.host: r["rank"] for r in read_rank_list(spark, str(ranks)).collect()}
    assert (got["top0"], got["top1"], got["low0"], got["low499"]) == (0, 1, 2, 501)


def test_rewriting_a_slot_without_rows_clears_it(spark, tmp_path):
    from flowloom.plans.store import SlotStore

    store = SlotStore(spark, str(tmp_path / "store"))
    df = spark.createDataFrame([(D, 1), (D, 2)], "slot_start timestamp, x int")
    store.write("t", df, [(D, D + DAY)])
    store.write("t", df.where("x > 9"), [(D, D + DAY)])
    assert store.read("t", [(D, D + DAY)]).count() == 0


def test_times_in_both_spellings(spark, values):
    from flowloom.functions.times import epoch_seconds

    assert values("ts string", [("2024-01-01 00:05:00.25",), ("1704067500.25",), ("x",)], epoch_seconds("ts")) == [1704067500.25, 1704067500.25, 0.0]


def test_matches_labels_and_chains_over_files(spark, tmp_path):
    root = tmp_path / "raw"
    at = D + timedelta(hours=3)
    put_log(root, "http", at, [http("u1", at, "10.0.0.9", "h.com", **{"id.orig_p": 5})])
    put(root / "fireeye" / "2024-01-01" / "fireeye_20240101.log.gz", [
        {"src": "10.1.1.1", "dst": "10.0.0.9", "spt": 80, "dpt": 5, "anon_src": "none", "anon_dst": "home",
         "rt": "Jan 01 2024 03:04:00 UTC", "eventName": "malware-callback", "request": "http://h.com/x"}])
    ends = {"id.orig_h": "10.0.0.9", "id.resp_h": "10.1.1.1", "id.orig_p": 5, "id.resp_p": 443, "ts": slots.epoch(at)}
    put_log(root, "conn", at, [{"uid": "s1", "conn_state": "SF", **ends}, {"uid": "s2", "conn_state": "SF", **ends}])
    put_log(root, "ssl", at, [{"uid": "s1", "established": True, "anon_orig": "home", "cert_chain_fuids": ["f1", "f2"],
                              "server_name": "h.com", "validation_status": "ok", "subject": "CN=h.com,O=H", "issuer": "CN=ca,O=Big Inc", **ends}])
    put_log(root, "x509", at, [
        {"id": "f1", "ts": slots.epoch(at), "certificate.serial": "1", "certificate.issuer": "CN=ca,O=Big Inc", "certificate.subject": "CN=h.com",
         "certificate.not_valid_before": slots.epoch(D), "certificate.not_valid_after": slots.epoch(D + 10 * DAY), "san.dns": ["a.h.com", "b.h.com"]},
        {"id": "f2", "ts": slots.epoch(at), "certificate.serial": "2", "certificate.issuer": "CN=root", "certificate.subject": "CN=ca",
         "certificate.not_valid_before": slots.epoch(D), "certificate.not_valid_after": slots.epoch(D + 10 * DAY)}])
    tables = {
        "public_suffixes": spark.createDataFrame([("com",)], "suffix string"),
        "ca_issuers": spark.createDataFrame([("Big", "public")], "issuer_name string, category string"),
        "rank_list": spark.createDataFrame([("h.com", 4)], "host string, rank long"),
    }
    resolver = Resolver(spark, build_registry(), str(root), settings=Settings(tables=tables, seed="empty"))
    one = (at, at + HALF_HOUR)
    assert [(r.host, r.fe_score) for r in resolver.get("fireeye_score_v2", D, D + DAY).collect()] == [("h.com", 1.0)]
    assert [(r.host, r.fe_score) for r in resolver.get("fireeye_score_v1", D, datetime(2024, 2, 1)).collect()] == [("h.com", 1.0)]
    assert [r.fqdn for r in resolver.get("fireeye_MCBL_v1", D, D + DAY).collect()] == ["h.com"]
    assert sorted((r.uid, r.label) for r in resolver.get("ssl_mismatch_label", *one).collect()) == [("s1", 1), ("s2", 4)]
    pair = resolver.get("pre_process", *one).first()
    assert (pair.id, pair.root_id, pair.domain_suffix_from_sandns, pair.validity_days, pair.cert_age) == ("f1", "f2", ["h.com"], 10, 0.125)
    assert [r.ca_category for r in resolver.get("ca_categorize_v2", D, D + DAY).collect()] == ["public"]
    assert [(r.issuer_O, r["count"]) for r in resolver.get("find_ca", D, D + DAY).collect()] == [("Big Inc", 1)]
    assert [r.cisco1m_index for r in resolver.get("cisco1m", D, D + DAY).collect()] == [4]
    assert resolver.get("x509dailycert", D, D + DAY).count() == 2
    assert resolver.get("conn_ssl", *one).first().conn_state == "SF"
    assert [r.cnt_server for r in resolver.get("http_fqdn_perIP", D, D + DAY).collect()] == [1]
    # The second log of a merge may be missing: its side is then NULL.
    merged = resolver.get("httpssl_popularity_host", D, D + DAY)
    assert [(r.host, r.cnt_logs) for r in merged.collect()] == [("h.com", 2)]


def test_rank_lists_count_from_the_top(spark, tmp_path):
    from flowloom.sources.feeds import read_ca_lists, read_rank_list

    (tmp_path / "ranks.csv").write_text("host\n" + "".join(f"h{i}.com\n" for i in range(5000)))
    small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        ranks = read_rank_list(spark, str(tmp_path / "ranks.csv"))
        assert [r.host for r in ranks.orderBy("rank").collect()] == [f"h{i}.com" for i in range(5000)]
        assert [r.rank for r in ranks.orderBy("rank").collect()] == list(range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small)
    (tmp_path / "pub.csv").write_text("issuer_name\nBig\n")
    assert read_ca_lists(spark, {"public": str(tmp_path / "pub.csv")}).first().category == "public"


def test_ssh_blacklist_days(spark, tmp_path):
    root = tmp_path / "raw"
    put_log(root, "ssh", D, [{"uid": "u", "id.orig_h": "6.6.6.6", "id.resp_h": "10.0.0.1", "auth_attempts": 9, "auth_success": True}])
    for day, ip in ((0, "7.7.7.7"), (1, "6.6.6.6"), (2, "10.0.0.1")):
        folder = root / "honeypot" / f"{D + day * DAY:%Y-%m-%d}"
        folder.mkdir(parents=True)
        (folder / f"honeypot_{D + day * DAY:%Y-%m-%d}.csv").write_text(f"indicator,description\n{ip},x\n")
    resolver = Resolver(spark, build_registry(), str(root), settings=Settings(seed="empty"))
    get = lambda name: [(r.id_orig_h_inHoneypot, r.id_resp_h_inHoneypot) for r in resolver.get(name, D, D + DAY).collect()]
    assert get("ssh_bf_succ_honeypot") == [] and get("ssh_bf_succ_honeypot_retro1") == [(1, 0)] and get("ssh_bf_succ_honeypot_retro2") == [(0, 1)]
    with pytest.raises(MissingInput):
        resolver.get("ssh_bf_succ_honeypot", D + 5 * DAY, D + 6 * DAY)


def test_series_and_periodicity_over_files(spark, tmp_path):
    root = tmp_path / "raw"
    for half in range(10, 48):
        at = D + half * HALF_HOUR
        rows = [http(f"u{half}{m}", at + timedelta(minutes=m), "c", "beacon.com") for m in (0, 10, 20)]
        put_log(root, "http", at, rows)
        put_log(root, "http_vt", at, rows[:1])
    resolver = Resolver(spark, build_registry(), str(root), settings=Settings(seed="empty"))
    found = resolver.get("http_periodicity", D, D + DAY).first()
    assert found.ts_cnt == 114 and 10.0 in [round(p, 3) for p in found.true_periods]
    both = resolver.get("http_periodicity_agg", D, D + DAY).first()
    assert both.ts_cnt == 114 + 38 and sum(both.tdf) == 152
    assert resolver.get("httpssl_ts", D, D + DAY).first().ts_cnt == 114
    assert [r.host for r in resolver.get("http_periodicity_hist", D, D + DAY).collect()] == ["beacon.com"]


def test_every_feature_has_a_schema(spark, tmp_path):
    tables = {
        "public_suffixes": spark.createDataFrame([], "suffix string"),
        "ca_issuers": spark.createDataFrame([], "issuer_name string, category string"),
        "rank_list": spark.createDataFrame([], "host string, rank long"),
    }
    reg = build_registry()
    resolver = Resolver(spark, reg, str(tmp_path), settings=Settings(tables=tables, seed="empty"))
    for name in reg:
        assert "slot_start" in resolver._empty(reg[name]).columns, name


def test_save_dir_and_backfill(spark, site, tmp_path):
    resolver = Resolver(spark, build_registry(), str(site))
    elsewhere = str(tmp_path / "saved")
    resolver.get("popularity_ua", D, D + DAY, save_dir=elsewhere)
    assert SlotStore(spark, store_root(elsewhere)).slots_of("popularity_ua") == [(D, D + DAY)]
    assert SlotStore(spark, store_root(str(site))).slots_of("popularity_ua") == []
    report = resolver.backfill(["popularity_uri", "http_cnt_respIP", "renisac"], D, D + DAY)
    assert report["popularity_uri"].startswith("1 slots") and "missing" in report["renisac"]


def test_command_line(spark, site, capsys):
    from flowloom.__main__ import main

    span = ["--root_dir", str(site), "--start_time", "2024-01-01", "--end_time", "2024-01-03"]
    main(["compute", *span, "popularity_ua"])
    main(["ls", *span, "popularity_ua"])
    main(["ls", *span, "--output_format", "options", "popularity_ua"])
    main(["topk", *span, "popularity_ua", "cnt_distinct_hosts", "user_agent", "--k", "1"])
    main(["deps", "find_ca"])
    out = capsys.readouterr().out
    assert "2024-01-01 00:00:00   --->   2024-01-03 00:00:00" in out and "--start_time '2024-01-02 00:00:00'" in out
    assert "popularity_ua: 2 slots" in out and "ssl\nfind_ca" in out


def test_recipes_added_by_callers(spark, tmp_path):
    reg = Registry()

    class Ones:
        def available(self, spark, root, wanted):
            return {s for s in wanted if s[0].hour != 1}

        def read(self, spark, root, wanted):
            return spark.createDataFrame([(slots.epoch(s), 1) for s, _ in wanted], "e long, n int").select(
                F.timestamp_seconds("e").alias("slot_start"), "n")

        def empty(self, spark):
            return self.read(spark, "", [(D, D)]).where(F.lit(False))

    reg.add(Feature("ones", loader=Ones()))

    @reg.feature(Input("ones", ("n",), on_missing="skip"), timescale=slots.HOUR, memoize=True)
    def total(context, ones):
        return ones.groupBy("slot_start").agg(F.sum("n").alias("n"))

    resolver = Resolver(spark, reg, str(tmp_path))
    got = resolver.get("total", D, D + timedelta(hours=3), keep_slot=True)
    assert sorted((r.slot_start.hour, r.n) for r in got.collect()) == [(0, 2), (2, 2)]


# -- plans

NATIVE = [n for n in QUERIES if not n.startswith(("stream_", "resolve_", "slot_", "scan_", "late_", "missing_", "load_", "backfill", "autocorr", "period", "candidate", "acf_", "lowpass_"))]


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["find_ca"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_linenumber:int,l_returnflag:string,l_linestatus:string>" in plan
    plan = QUERIES["ssh_bf_succ"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_linenumber,3)" in plan
