"""Counts over connections: addresses per host, hosts per address, first log per connection, profiles of endpoints."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.scores import is_established
from flowloom.functions.times import validity_days
from flowloom.operators.tables import keep_one
from flowloom.session import removed, shared_dir, written

TUPLE = ("id_orig_h", "id_resp_h", "id_resp_p")
#: Measures of :func:`tls_tuple_profile`.
PROFILE = (
    "conn_count", "ssl_agg_count", "dur_mean", "dur_std", "sum_orig_bytes", "sum_resp_bytes", "sum_orig_pkts",
    "sum_resp_pkts", "mean_cert_fuids", "mean_validity_len", "std_validity_len", "num_cert_invalid",
    "ratio_cert_age_valid", "unique_cert_fuids", "mean_num_san_dns_domains", "ratio_responder_to_all_bytes",
    "ratio_established_conn_state", "ratio_conn_to_ssl", "ratio_tls_ssl", "ratio_null_sni", "ratio_self_signed",
    "all_sni_in_san_dns", "prcnt_outside_std_dev", "periodicity_mean", "periodicity_std",
)
#: Differences below this are rounding.
_NOISE = 1e-9
_DAY = 86400
#: Connections a task of a profile's widest steps gets, about; more connections make more tasks.
TASK_ROWS = 250_000
#: Connections of one pass of a profile, about, and the most passes: each reads all input once more.
PASS_ROWS, PASSES = 8_000_000, 8
#: Bytes of a task that makes TLS facts: its sorts take some twenty times as much memory.
FACTS_TASK = "8m"
#: Keys are counted by so many hashes; those with more connections than this may hold a hot key.
KEY_HASHES, HOT_ROWS = 16_384, 250_000


def profile_tasks(df: DataFrame, rows: int | None = None) -> int:
    """Tasks among which a profile is dealt: as many as its rows need, however few shuffle partitions are set."""
    session = df.sparkSession
    least = min(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    return max(least, -(-(df.count() if rows is None else rows) // TASK_ROWS))


def key_passes(sizes: dict[int, int]) -> list[tuple[list[int], int, bool]]:
    """Hashes of keys that go through a profile together, their connections, and whether there may be hot keys among them.

    ``sizes`` has the connections of each hash. A pass has all hashes of its kind between its first and its last.
    """
    total = sum(sizes.values())
    most, hot = max(PASS_ROWS, -(-total // PASSES)), max(HOT_ROWS, 4 * total // KEY_HASHES)
    passes = []
    for is_hot in (False, True):
        mine = sorted(h for h, n in sizes.items() if (n > hot) == is_hot)
        rows = sum(sizes[h] for h in mine)
        each = -(-rows // max(1, -(-rows // most)))  # passes of equal size
        group, n = [], 0
        for h in mine:
            group.append(h)
            n += sizes[h]
            if n >= each or h == mine[-1]:
                passes.append((group, n, is_hot))
                group, n = [], 0
    return passes


def addresses_per_host(
    df: DataFrame, host: str = "host", address: str = "id_resp_h", by: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(*by, host).agg(F.countDistinct(address).alias("cnt_IP"))


def hosts_per_address(
    df: DataFrame, host: str = "host", address: str = "id_resp_h", by: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(*by, address).agg(F.countDistinct(host).alias("cnt_server"))


def first_logs(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Earliest time per connection key."""
    return df.groupBy(*keys).agg(F.min(ts).alias(ts))


def tuple_profile(
    df: DataFrame, keys: Sequence[str] = ("id_orig_h", "id_resp_h", "id_resp_p"), duration: str = "duration",
    orig_bytes: str = "orig_bytes", resp_bytes: str = "resp_bytes", established: str = "established_state",
    has_ssl: str = "has_ssl",
) -> DataFrame:
    """Aggregates per (originator, responder, port): volume, duration, responder and state ratios.

    Only partial-aggregable functions, so a hot tuple is reduced before the shuffle.
    """
    total = F.sum(orig_bytes) + F.sum(resp_bytes)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("conn_count"),
        F.sum(F.col(has_ssl).cast("long")).alias("ssl_agg_count"),
        F.avg(duration).alias("dur_mean"),
        F.stddev_samp(duration).alias("dur_std"),
        F.sum(orig_bytes).alias("sum_orig_bytes"),
        F.sum(resp_bytes).alias("sum_resp_bytes"),
        F.try_divide(F.sum(resp_bytes), total).alias("ratio_responder_to_all_bytes"),
        F.avg(F.col(established).cast("double")).alias("ratio_established_conn_state"),
        F.try_divide(F.count(F.lit(1)), F.sum(F.col(has_ssl).cast("long"))).alias("ratio_conn_to_ssl"),
    )


def tls_facts(
    ssl: DataFrame, x509: DataFrame, uid: str = "uid", chain: str = "cert_chain_fuids", cert: str = "id",
    version: str = "version", server: str = "server_name", issuer: str = "certificate_issuer",
    subject: str = "certificate_subject", before: str = "certificate_not_valid_before",
    after: str = "certificate_not_valid_after", san: str = "san_dns",
) -> DataFrame:
    """One row per TLS connection with what its leaf certificate says; of repeated records, the smallest facts stay.

    NULL where a record names no server, or its certificate is not known.
    """
    leaves = x509.select(
        F.col(cert).alias("cert_id"), F.col(before).alias("not_before"), F.col(after).alias("not_after"),
        (F.col(issuer) == F.col(subject)).alias("self_signed"), F.when(F.col(san).isNotNull(), F.size(san)).alias("san_domains"),
        F.col(san).alias("_san"),
    )
    links = ssl.select(
        F.col(uid).alias("uid"), F.lower(version).startswith("tls").alias("is_tls"), F.col(server).alias("_server"),
        F.when(F.col(chain).isNotNull(), F.size(chain)).alias("cert_fuids"), F.get(chain, F.lit(0)).alias("cert_id"),
    )
    facts = links.join(leaves, "cert_id", "left").select(
        "uid", "is_tls", F.col("_server").isNull().alias("null_sni"), "cert_fuids", "cert_id", "not_before", "not_after",
        "self_signed", "san_domains", F.array_contains("_san", F.col("_server")).alias("sni_in_san"),
    )
    return keep_one(facts, ["uid"])


def gap_moments(df: DataFrame, keys: Sequence[str], ts: str = "ts", tasks: int | None = None) -> DataFrame:
    """Mean and standard deviation of the whole seconds between neighbouring rows of a key, ``periodicity_mean`` and ``_std``.

    The mean needs only the ends. Squares are summed within days, over at most 86,400 moments, and between the days of a key,
    so a hot key is never sorted as a whole. Days and keys are dealt among ``tasks``, by default as many as the rows need.
    """
    tasks = tasks or profile_tasks(df)
    moments = df.where(F.col(ts).isNotNull()).groupBy(*keys, F.unix_timestamp(ts).alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    moments = moments.withColumn("_day", F.floor(F.col("_s") / _DAY)).repartition(tasks, *keys, "_day")
    gap = F.col("_s") - F.lag("_s").over(Window.partitionBy(*keys, "_day").orderBy("_s"))
    squared = lambda c: F.sum((F.col(c) * F.col(c)).cast("decimal(38,0)"))
    days = moments.withColumn("_gap", gap).groupBy(*keys, "_day").agg(
        F.sum("_n").alias("_n"), F.min("_s").alias("_first"), F.max("_s").alias("_last"), squared("_gap").alias("_squares")
    )
    hop = F.col("_first") - F.lag("_last").over(Window.partitionBy(*keys).orderBy("_day"))
    none = F.lit(0).cast("decimal(38,0)")
    whole = days.repartition(tasks, *keys).withColumn("_hop", hop).groupBy(*keys).agg(
        F.sum("_n").alias("_n"), (F.max("_last") - F.min("_first")).alias("_span"),
        (F.coalesce(F.sum("_squares"), none) + F.coalesce(squared("_hop"), none)).cast("decimal(38,0)").alias("_squares"),
    )
    return whole.select(*keys, *_gap_measures(F.col("_n"), F.col("_span"), F.col("_squares")))


def _gap_measures(n: Column, span: Column, squares: Column) -> list[Column]:
    """``periodicity_mean`` and ``_std`` of ``n`` moments, the seconds between their ends, and the sum of the gaps' squares."""
    span = span.cast("decimal(19,0)")
    # In whole numbers up to the last division: equal gaps have a deviation of exactly 0.
    spread = (n - 1).cast("decimal(19,0)") * squares - span * span
    return [
        F.try_divide(span.cast("double"), n - 1).alias("periodicity_mean"),
        F.when(n > 2, F.sqrt(F.try_divide(spread.cast("double"), (n - 1) * (n - 2)))).alias("periodicity_std"),
    ]


def tls_tuple_profile(
    conn: DataFrame, facts: DataFrame, keys: Sequence[str] = TUPLE, uid: str = "uid", ts: str = "ts",
    duration: str = "duration", orig_bytes: str = "orig_bytes", resp_bytes: str = "resp_bytes",
    orig_pkts: str = "orig_pkts", resp_pkts: str = "resp_pkts", state: str = "conn_state",
) -> DataFrame:
    """All measures of an (originator, responder, port): volume, duration, gaps, states, TLS and certificates.

    ``facts`` is :func:`tls_facts`. What TLS needs is joined by connection. Then the connections of a key meet in one task, once;
    keys that may be hot, by exact counts of their hashes, are reduced in steps instead. Many connections go in passes by
    the hash of their key: each is written below the shared folder and its shuffles are removed, so that the disk never has
    the shuffles of all.
    """
    keys, spark = list(keys), conn.sparkSession
    named = zip((uid, ts, duration, orig_bytes, resp_bytes, orig_pkts, resp_pkts), ("_uid", "_ts", "_d", "_ob", "_rb", "_op", "_rp"))
    conn = conn.select(*keys, *[F.col(c).alias(n) for c, n in named], is_established(state).alias("_up"))
    facts = facts.withColumnRenamed("uid", "_uid")
    hashed = F.pmod(F.xxhash64(*keys), F.lit(KEY_HASHES))
    passes = key_passes({r["_hash"]: r["count"] for r in conn.groupBy(hashed.alias("_hash")).count().collect()})
    if len(passes) < 2:
        rows, hot = passes[0][1:] if passes else (0, False)
        tasks = profile_tasks(conn, rows)
        return _profile(conn, facts, keys, hot, tasks, tasks)
    folder = shared_dir(spark, "profile")
    facts = written(facts, f"{folder}/facts", {"spark.sql.adaptive.advisoryPartitionSizeInBytes": FACTS_TASK})
    records, done = facts.count(), []
    hot_hashes = [h for group, _, hot in passes if hot for h in group]
    for i, (group, rows, hot) in enumerate(passes):
        mine = conn.where(hashed.between(group[0], group[-1]))
        if hot_hashes:
            mine = mine.where(hashed.isin(hot_hashes) if hot else ~hashed.isin(hot_hashes))
        part = _profile(mine, facts, keys, hot, profile_tasks(conn, rows), profile_tasks(conn, rows + records))
        done.append(written(part, f"{folder}/part-{i}"))
    removed(spark, f"{folder}/facts")
    return reduce(DataFrame.unionByName, done)


def _profile(conn: DataFrame, facts: DataFrame, keys: list[str], hot: bool, tasks: int, tasks_tls: int) -> DataFrame:
    """The profiles of ``conn`` in ``tasks`` tasks; ``facts`` are joined in ``tasks_tls``."""
    rows, tls = F.count(F.lit(1)), F.sum("_ssl")
    volume = [
        rows.alias("conn_count"), F.avg("_d").alias("dur_mean"), F.stddev_samp("_d").alias("dur_std"),
        F.sum("_ob").alias("sum_orig_bytes"), F.sum("_rb").alias("sum_resp_bytes"),
        F.sum("_op").alias("sum_orig_pkts"), F.sum("_rp").alias("sum_resp_pkts"),
        F.try_divide(F.sum("_rb"), F.sum("_ob") + F.sum("_rb")).alias("ratio_responder_to_all_bytes"),
        F.avg(F.col("_up").cast("double")).alias("ratio_established_conn_state"),
    ]
    age = F.unix_timestamp("_ts") - F.unix_timestamp("not_before")
    validity = F.unix_timestamp("not_after") - F.unix_timestamp("not_before")
    marked = conn.select(*keys, "_uid", "_ts").repartition(tasks_tls, "_uid").join(facts.repartition(tasks_tls, "_uid"), "_uid")
    marked = marked.select(
        *keys, "cert_fuids", "cert_id", "san_domains", "is_tls", "null_sni", "self_signed", "sni_in_san", F.lit(1).alias("_ssl"),
        validity_days("not_before", "not_after").alias("_days"), F.try_divide(age, validity).alias("_age"),
        ((F.col("_ts") < F.col("not_before")) | (F.col("_ts") > F.col("not_after"))).alias("_invalid"),
    )
    if not hot:  # the first of each certificate counts, in any order
        marked = marked.repartition(tasks, *keys)
        before = F.lag("cert_id").over(Window.partitionBy(*keys).orderBy("cert_id"))
        marked = marked.withColumn("_new", F.col("cert_id").isNotNull() & ~F.col("cert_id").eqNullSafe(before))
    count = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0))
    secured = marked.groupBy(*keys).agg(
        rows.alias("ssl_agg_count"), F.avg("cert_fuids").alias("mean_cert_fuids"), F.avg("_days").alias("mean_validity_len"),
        F.stddev_samp("_days").alias("std_validity_len"), count("_invalid").alias("num_cert_invalid"),
        F.avg("_age").alias("ratio_cert_age_valid"),
        (F.count_distinct("cert_id") if hot else count("_new")).alias("unique_cert_fuids"),
        F.avg("san_domains").alias("mean_num_san_dns_domains"), F.try_divide(count("is_tls"), tls).alias("ratio_tls_ssl"),
        F.try_divide(count("null_sni"), tls).alias("ratio_null_sni"),
        F.try_divide(count("self_signed"), tls).alias("ratio_self_signed"), F.min("sni_in_san").alias("all_sni_in_san_dns"),
    )
    if hot:
        parts = [part.repartition(tasks, *keys) for part in (conn.groupBy(*keys).agg(*volume), secured, _outside(conn, keys))]
        parts.append(gap_moments(conn, keys, "_ts", tasks))
    else:
        parts = [_whole_keys(conn.drop("_uid"), keys, volume, tasks), secured]
    # The parts meet by key, NULL keys too, as one aggregate over rows that are reduced already.
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    measures = [c for c in together.columns if c not in keys]
    whole = together.groupBy(*keys).agg(*[F.max(c).alias(c) for c in measures])
    whole = whole.fillna(0, ["ssl_agg_count", "num_cert_invalid", "unique_cert_fuids"])
    return whole.withColumn("ratio_conn_to_ssl", F.try_divide("conn_count", "ssl_agg_count")).select(*keys, *PROFILE)


def _far() -> Column:
    return F.abs(F.col("_d") - F.col("dur_mean")) - F.col("dur_std") > _NOISE


def _outside(conn: DataFrame, keys: list[str]) -> DataFrame:
    """``prcnt_outside_std_dev`` from the counts of distinct durations, so a hot key is reduced before it moves."""
    timed = conn.where(F.col("_d").isNotNull())
    moments = timed.groupBy(*keys).agg(F.avg("_d").alias("dur_mean"), F.stddev_samp("_d").alias("dur_std"))
    named = [f"_{k}" for k in keys]
    durations = timed.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, named)], "_d").agg(F.count(F.lit(1)).alias("_n"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, named)])
    return durations.join(moments, same).groupBy(*keys).agg(
        (F.lit(100) * F.sum(F.when(_far(), F.col("_n")).when(~_far(), 0)) / F.sum("_n")).alias("prcnt_outside_std_dev")
    )


def _whole_keys(conn: DataFrame, keys: list[str], volume: list[Column], tasks: int) -> DataFrame:
    """``volume``, the share of durations outside one deviation and the gaps, where all connections of a key meet in one task."""
    lines = conn.withColumn("_s", F.unix_timestamp("_ts")).drop("_ts").repartition(tasks, *keys)
    key = Window.partitionBy(*keys)
    lines = lines.withColumn("_gap", F.col("_s") - F.lag("_s").over(key.orderBy("_s")))
    lines = lines.withColumns({"dur_mean": F.avg("_d").over(key), "dur_std": F.stddev_samp("_d").over(key)})
    none = F.lit(0).cast("decimal(38,0)")
    squares = F.coalesce(F.sum((F.col("_gap") * F.col("_gap")).cast("decimal(38,0)")), none).cast("decimal(38,0)")
    outside = F.try_divide(F.lit(100) * F.sum(F.when(_far(), 1).when(~_far(), 0)), F.count("_d"))
    return lines.groupBy(*keys).agg(
        *volume, outside.alias("prcnt_outside_std_dev"),
        *_gap_measures(F.count("_s"), F.max("_s") - F.min("_s"), squares),
    )
