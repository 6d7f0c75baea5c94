"""Resolution queries: histories, late and missing input, appends, backfill, and scans of dated files."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from flowloom.plans.queries.bindings import NAMED, WEB, Tables, query
from flowloom.plans.queries.history import EXPIRY, _history_sql
from flowloom.plans.queries.popularity import DAILY_HOST, _extreme_sql
from flowloom.operators.popularity import HOST_MEASURES
from flowloom.plans.queries.storage import DAY_SECONDS, TableLoader, _resolver
from flowloom.plans.registry import Feature
from flowloom.plans.resolve import Settings
from flowloom.plans.slots import HALF_HOUR, epoch, from_epoch, tile
from flowloom.plans.store import SlotStore
from flowloom.session import shared_dir
from flowloom.sources.feeds import CsvLoader
from flowloom.sources.files import move

DAY = timedelta(days=1)
_TYPED = ", 'HTTP' AS firstseen_log_type, 'HTTP' AS lastseen_log_type, CAST(0 AS INTEGER) AS \"isIP\""
# Days that a gap or a late arrival is about, counted from the first.
GAP = (6, 7, 15)


def _hide(resolver, web, days) -> None:
    """Let the half hours of the web log that ``days`` names count as absent; none if it is None."""
    hidden = days or (lambda start: False)
    resolver.registry.entries["http"] = Feature("http", HALF_HOUR, loader=TableLoader(web, hidden=hidden))


def _history(found):
    return found.withColumn("day", F.col("slot_start").cast("date")).withColumnRenamed("anon_host", "user_agent").drop("slot_start")


@query("resolve_history", "WITH " + NAMED + ", " + _history_sql("SELECT DISTINCT day, host, user_agent FROM named", "host, user_agent", _TYPED))
def resolve_history(t: Tables):
    """Five days are stored from nothing; the days after them continue that state in one plan."""
    resolver, first, last = _resolver(t, Settings(seed="empty", expiry_days=EXPIRY))
    resolver.get("http_domain_history", first, first + 5 * DAY)
    return _history(resolver.get("http_domain_history", first, last, keep_slot=True))


_LOUD = f"SELECT DISTINCT day, host, user_agent FROM named WHERE day - (SELECT min(day) FROM named) NOT IN {GAP}"


@query(
    "resolve_history_gap",
    f"WITH {NAMED}, h AS (WITH {_history_sql(_LOUD, 'host, user_agent', _TYPED)}) FROM h "
    f"UNION ALL SELECT h.* REPLACE (q.day AS day) FROM h JOIN (SELECT max(h.day) AS before, g.day FROM h JOIN "
    f"(SELECT DISTINCT CAST((SELECT min(day) FROM named) + CAST(unnest({list(GAP)}) AS INTEGER) AS DATE) AS day) g ON h.day < g.day GROUP BY g.day) q ON h.day = q.before",
)
def resolve_history_gap(t: Tables):
    """Three days have no input: each has the history of the day before it, nothing expires on it."""
    resolver, first, last = _resolver(t, Settings(seed="empty", expiry_days=EXPIRY))
    web = t.web().withColumn("anon_host", F.col("user_agent"))
    _hide(resolver, web, lambda start: (start - first).days in GAP)
    resolver.get("http_domain_history", first, first + 7 * DAY)
    return _history(resolver.get("http_domain_history", first, last, keep_slot=True))


@query(
    "resolve_history_refilled",
    "WITH " + NAMED + ", " + _history_sql("SELECT DISTINCT day, host, user_agent FROM named", "host, user_agent", _TYPED),
)
def resolve_history_refilled(t: Tables):
    """Input of three days comes after the history was stored: that day's and all later ones are made anew."""
    resolver, first, last = _resolver(t, Settings(seed="empty", expiry_days=EXPIRY))
    web = t.web().withColumn("anon_host", F.col("user_agent"))
    _hide(resolver, web, lambda start: (start - first).days in GAP)
    resolver.get("http_domain_history", first, last)
    _hide(resolver, web, None)
    resolver.refresh("http_domain_history", first, last)
    return _history(resolver.load_available_slots("http_domain_history", first, last))


@query(
    "late_slots",
    f"""WITH {DAILY_HOST}, days AS (SELECT DISTINCT day, day - min(day) OVER () AS n FROM named)
    SELECT daily.* REPLACE (round(fqdn_norm, 6) AS fqdn_norm), n IN {GAP} AS late FROM daily JOIN days USING (day)""",
)
def late_slots(t: Tables):
    """The mornings of three days come late: these days, and no others, are found and made anew."""
    resolver, first, last = _resolver(t)
    web = t.web()
    _hide(resolver, web, lambda start: (start - first).days in GAP and start.hour < 12)
    resolver.get("popularity_host", first, last)
    _hide(resolver, web, None)
    late = resolver.refresh("popularity_host", first, last)
    whole = resolver.load_available_slots("popularity_host", first, last)
    starts = F.array(*[F.timestamp_seconds(F.lit(epoch(s))) for s, _ in late]).cast("array<timestamp>")
    return whole.select(
        F.col("slot_start").cast("date").alias("day"), *[c for c in whole.columns if c not in ("slot_start", "fqdn_norm")],
        F.round("fqdn_norm", 6).alias("fqdn_norm"), F.array_contains(starts, F.col("slot_start")).alias("late"),
    )


@query(
    "missing_slots",
    f"""WITH {DAILY_HOST}, n AS (SELECT max(day) - min(day) AS last, min(day) AS low FROM named),
    kept AS (SELECT daily.* FROM daily, n WHERE day - low NOT IN (0, 9) AND day - low <> last),
    wide AS (SELECT 'fiveday_popularity_host' AS feature, d.day, k.host, max(k.cnt_logs) AS n FROM (SELECT DISTINCT day FROM daily) d JOIN kept k
      ON k.day < d.day AND k.day >= d.day - 5 WHERE d.day >= (SELECT low + 5 FROM n) GROUP BY ALL)
    SELECT 'popularity_host' AS feature, day, host, cnt_logs AS n FROM kept UNION ALL FROM wide""",
)
def missing_slots(t: Tables):
    """The first, a middle and the last day have no input: they have no table, and five-day tables use the other days."""
    resolver, first, last = _resolver(t)
    days = {0, 9, (last - first).days - 1}
    _hide(resolver, t.web(), lambda start: (start - first).days in days)
    one = resolver.get("popularity_host", first, last, allow_missing=True, keep_slot=True)
    five = resolver.get("fiveday_popularity_host", first + 5 * DAY, last, allow_missing=True, keep_slot=True)
    told = lambda df, name, n: df.select(F.lit(name).alias("feature"), F.col("slot_start").cast("date").alias("day"), "host", F.col(n).alias("n"))
    return told(one, "popularity_host", "cnt_logs").union(told(five, "fiveday_popularity_host", "max5day_cnt_logs"))


@query(
    "load_available",
    f"WITH {DAILY_HOST} SELECT day, host, cnt_logs FROM daily WHERE (day - (SELECT min(day) FROM named)) % 4 = 1",
)
def load_available(t: Tables):
    """Every fourth day is stored; a load of the whole range computes nothing."""
    resolver, first, last = _resolver(t)
    for day in tile(first, last, DAY)[1::4]:
        resolver.get("popularity_host", *day)
    whole = resolver.load_available_slots("popularity_host", first, last)
    return whole.select(F.col("slot_start").cast("date").alias("day"), "host", "cnt_logs")


@query(
    "backfill",
    f"""WITH {DAILY_HOST}, days AS (SELECT DISTINCT day FROM named), f AS ({_extreme_sql('host', HOST_MEASURES)})
    SELECT 'popularity_host' AS feature, day, count(*) AS rows, 3::INT AS measures FROM daily GROUP BY day
    UNION ALL SELECT 'fiveday_popularity_host', day, count(*), {2 * len(HOST_MEASURES)} FROM f WHERE day >= (SELECT min(day) + 5 FROM days) GROUP BY day""",
)
def backfill(t: Tables):
    """Two tables, named in the wrong order, are computed inputs first; the manifest tells rows and columns of each slot."""
    resolver, first, last = _resolver(t)
    resolver.backfill(["popularity_host"], first, last)
    report = resolver.backfill(["fiveday_popularity_host", "popularity_host"], first + 5 * DAY, last)
    assert list(report) == ["popularity_host", "fiveday_popularity_host"]
    parts = []
    for name in report:
        (slot, *_) = tile(first + 5 * DAY, last, DAY)
        measures = [c for c in resolver.store.describe(name, slot)["columns"] if c != "host"]
        told = resolver.store.manifest(name).select(F.timestamp_seconds("start_epoch").cast("date").alias("day"), "rows")
        parts.append(told.select(F.lit(name).alias("feature"), "day", "rows", F.lit(len(measures)).alias("measures")))
    return parts[0].union(parts[1])


@query(
    "slot_append_retry",
    f"""WITH {WEB}, per AS (SELECT day, user_agent, host, count(*) AS n FROM web GROUP BY ALL)
    SELECT day, host, n, user_agent AS batch FROM per WHERE user_agent IN ('error', 'click')
    UNION ALL SELECT day, host, count(*), 'all' FROM web WHERE day > (SELECT min(day) FROM web) GROUP BY day, host""",
)
def slot_append_retry(t: Tables):
    """Two batches are appended to days, one of them three times; a day written again without rows loses its own."""
    web = t.web()
    counted = lambda df, batch: df.groupBy(F.col("day").cast("timestamp").alias("slot_start"), "host").agg(
        F.count(F.lit(1)).alias("n")).withColumn("batch_name", F.lit(batch))
    starts = sorted(r[0] for r in web.select(F.unix_timestamp(F.col("day").cast("timestamp"))).distinct().collect())
    slots = [(from_epoch(s), from_epoch(s + DAY_SECONDS)) for s in starts]
    store = SlotStore(t.spark, shared_dir(t.spark, "slots"))
    store.write("counts", counted(web, "all"), slots)
    store.write("counts", counted(web, "all").where(F.lit(False)), slots[:1])
    for batch in ("error", "click", "error", "error"):
        store.append("counts", counted(web.where(F.col("user_agent") == batch), batch), slots, batch=batch)
    out = store.read("counts", slots)
    return out.select(F.col("slot_start").cast("date").alias("day"), "host", "n", F.col("batch_name").alias("batch"))


@query(
    "scan_alerts",
    f"""WITH {WEB} SELECT day, CAST(id_orig_h AS VARCHAR) AS src, id_resp_h AS dst, k AS spt, user_agent AS "eventName", 'x' || k AS extra
    FROM web WHERE day - (SELECT min(day) FROM web) <> 3""",
)
def scan_alerts(t: Tables):
    """Daily alert files, one of them missing, read by name through the resolver; columns no schema names are kept."""
    root = shared_dir(t.spark, "alerts")
    web = t.web()
    resolver, first, last = _resolver(t)
    rows = web.select(
        F.col("id_orig_h").cast("string").alias("src"), F.col("id_resp_h").alias("dst"), F.col("k").alias("spt"),
        F.date_format("ts", "MMM dd yyyy HH:mm:ss 'UTC'").alias("rt"), F.col("user_agent").alias("eventName"), F.concat(F.lit("x"), "k").alias("extra"), "day",
    )
    rows.where(F.col("day") != F.lit((first + 3 * DAY).date())).repartition("day").write.partitionBy("day").option("compression", "gzip").json(f"{root}/written")
    resolver.raw_root = root
    for start, _ in tile(first, last, DAY):
        move(t.spark, f"{root}/written/day={start:%Y-%m-%d}", f"{root}/fireeye/{start:%Y-%m-%d}/fireeye_{start:%Y%m%d}.log.gz")
    out = resolver.get("fireeye", first, last, allow_missing=True, keep_slot=True)
    return out.select(F.col("slot_start").cast("date").alias("day"), "src", "dst", "spt", "eventName", "extra")


@query(
    "scan_cache",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, 'o' || o_custkey AS fqdn, CAST(o_orderkey % 7 AS INTEGER) AS positives, 70::INT AS total
    FROM orders WHERE date_trunc('month', o_orderdate) < (SELECT date_trunc('month', min(o_orderdate)) + INTERVAL 6 MONTH FROM orders)""",
)
def scan_cache(t: Tables):
    """Half a year of monthly reputation caches, read by name through the resolver."""
    root = shared_dir(t.spark, "cache")
    orders = t.table("orders").select(
        F.concat(F.lit("o"), "o_custkey").alias("fqdn"), F.col("o_orderdate").cast("date").cast("string").alias("date"),
        (F.col("o_orderkey") % 7).alias("positives"), F.lit(70).alias("total"), F.trunc("o_orderdate", "month").alias("month"),
    )
    first = orders.agg(F.min("month")).first()[0]
    begin = from_epoch((first - type(first)(1970, 1, 1)).days * DAY_SECONDS)
    end = begin.replace(year=begin.year + (begin.month + 5) // 12, month=(begin.month + 5) % 12 + 1)
    orders.where(F.col("month") < F.lit(end.date())).repartition("month").write.partitionBy("month").option("header", True).csv(f"{root}/written")
    resolver, *_ = _resolver(t)
    resolver.raw_root = root
    loader = CsvLoader("virustotal_cache")
    for slot in tile(begin, end, resolver.registry["virustotal_cache"].timescale):
        move(t.spark, f"{root}/written/month={slot[0]:%Y-%m-%d}", loader.path(root, slot))
    out = resolver.get("virustotal_cache", begin, end, keep_slot=True)
    return out.select(F.col("slot_start").cast("date").alias("month"), "fqdn", "positives", "total")
