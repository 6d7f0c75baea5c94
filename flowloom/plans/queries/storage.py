"""Store, resolution and scan queries.

Files are written below the shared folder the session names, from the given tables, and read back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators.cleaning import clean_log
from flowloom.operators.popularity import HOST_MEASURES
from flowloom.plans.catalog import build_registry
from flowloom.plans.queries.bindings import NAMED, WEB, Tables, query
from flowloom.plans.queries.popularity import DAILY_HOST, _extreme_sql
from flowloom.plans.queries.tables import _report_lines
from flowloom.plans.registry import Feature
from flowloom.plans.resolve import Resolver, Settings, in_runs
from flowloom.plans.slots import HALF_HOUR, Slot, from_epoch
from flowloom.plans.store import SlotStore
from flowloom.sources.feeds import scan_csv
from flowloom.sources.logs import scan_json
from flowloom.sources.reports import parse_reports, pivot_verdicts
from flowloom.session import shared_dir

DAY_SECONDS = 86400


class TableLoader:
    """A table with a time column as a raw feature in half-hour slots; every slot is there but those ``hidden``."""

    def __init__(self, table: DataFrame, ts: str = "ts", hidden: Callable[[datetime], bool] = lambda start: False):
        self.table = table.withColumn("slot_start", F.window(ts, "30 minutes")["start"])
        self.hidden = hidden

    def available(self, spark: SparkSession, root: str, slots: list[Slot]) -> set[Slot]:
        return {s for s in slots if not self.hidden(s[0])}

    def read(self, spark: SparkSession, root: str, slots: list[Slot]) -> DataFrame:
        return self.table.where(in_runs("slot_start", sorted(slots)))

    def empty(self, spark: SparkSession) -> DataFrame:
        return self.table.where(F.lit(False))


def _resolver(t: Tables, settings: Settings | None = None) -> tuple[Resolver, datetime, datetime]:
    web = t.web().withColumn("anon_host", F.col("user_agent"))
    registry = build_registry()
    registry.entries["http"] = Feature("http", HALF_HOUR, loader=TableLoader(web))
    low, high = web.agg(F.unix_timestamp(F.min("ts")), F.unix_timestamp(F.max("ts"))).first()
    first = from_epoch(low // DAY_SECONDS * DAY_SECONDS)
    last = from_epoch(high // DAY_SECONDS * DAY_SECONDS + DAY_SECONDS)
    return Resolver(t.spark, registry, shared_dir(t.spark, "store"), settings=settings), first, last


@query(
    "resolve_popularity",
    f"WITH {DAILY_HOST} SELECT * REPLACE (round(fqdn_norm, 6) AS fqdn_norm) FROM daily",
)
def resolve_popularity(t: Tables):
    """A third of the days is stored first; the range then mixes stored and computed days."""
    resolver, first, last = _resolver(t)
    resolver.get("popularity_host", first, first + (last - first) // 3 // timedelta(days=1) * timedelta(days=1))
    whole = resolver.get("popularity_host", first, last, keep_slot=True)
    return whole.withColumns({"fqdn_norm": F.round("fqdn_norm", 6), "day": F.col("slot_start").cast("date")}).drop("slot_start")


@query(
    "resolve_fiveday",
    f"""WITH {DAILY_HOST}, f AS ({_extreme_sql('host', HOST_MEASURES)})
        SELECT * FROM f WHERE day >= (SELECT min(day) + 5 FROM named)""",
)
def resolve_fiveday(t: Tables):
    """Each day reads the five days before it, which are computed and stored on the way."""
    resolver, first, last = _resolver(t)
    out = resolver.get("fiveday_popularity_host", first + timedelta(days=5), last, keep_slot=True)
    ratios = {c: F.round(c, 6) for c in out.columns if c.endswith("norm")}
    return out.withColumns({**ratios, "day": F.col("slot_start").cast("date")}).drop("slot_start")


@query(
    "resolve_series",
    f"WITH {NAMED} SELECT DISTINCT day, host FROM named",
)
def resolve_series(t: Tables):
    """Which hosts have a stored series on which day."""
    resolver, first, last = _resolver(t)
    registry = resolver.registry
    registry.entries["http"] = Feature(
        "http", HALF_HOUR, loader=TableLoader(t.web().withColumn("seconds", F.col("ts").cast("double")))
    )
    inner = registry["http_ts"]
    registry.entries["http_ts"] = inner.also(
        inputs=(inner.inputs[0].__class__("http", ("uid", "seconds", "id_resp_h", "host")),),
        compute=lambda ctx, log: inner.compute(ctx, log.withColumnRenamed("seconds", "ts")),
    )
    out = resolver.get("http_ts", first, last, ["host"], keep_slot=True)
    return out.select(F.col("slot_start").cast("date").alias("day"), "host")


@query(
    "slot_store",
    f"WITH {WEB} SELECT day, host, count(*) AS n, CAST(sum(k) AS BIGINT) AS total FROM web GROUP BY ALL UNION ALL "
    f"SELECT day, host, count(*), CAST(sum(k) AS BIGINT) FROM web WHERE user_agent = 'error' GROUP BY ALL",
)
def slot_store(t: Tables):
    """Days are written, written again, appended to, and read back by slot with two of three columns."""
    web = t.web()
    counts = lambda df: df.groupBy(F.col("day").cast("timestamp").alias("slot_start"), "host").agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"), F.max("k").alias("top")
    )
    starts = [r[0] for r in web.select(F.unix_timestamp(F.col("day").cast("timestamp"))).distinct().collect()]
    slots = [(from_epoch(s), from_epoch(s + DAY_SECONDS)) for s in sorted(starts)]
    store = SlotStore(t.spark, shared_dir(t.spark, "slots"))
    store.write("counts", counts(web), slots)
    store.write("counts", counts(web), slots)
    store.append("counts", counts(web.where("user_agent = 'error'")), slots)
    out = store.read("counts", slots, ["host", "n", "total"])
    return out.select(F.col("slot_start").cast("date").alias("day"), "host", "n", "total")


@query(
    "slot_manifest",
    f"WITH {WEB}, d AS (SELECT day, count(*) AS rows FROM (SELECT DISTINCT day, host FROM web) GROUP BY day) "
    "SELECT CAST(epoch(day) AS BIGINT) AS start_epoch, CAST(epoch(day) + 86400 AS BIGINT) AS end_epoch, rows FROM d",
)
def slot_manifest(t: Tables):
    resolver, first, last = _resolver(t)
    resolver.get("http_cnt_respIP", first, last)
    return resolver.store.manifest("http_cnt_respIP").select("start_epoch", "end_epoch", "rows")


@query(
    "scan_json",
    f"""WITH {WEB} SELECT CAST(uid AS VARCHAR) AS uid, round(epoch(ts), 6) AS ts, CAST(id_orig_h AS VARCHAR) AS id_orig_h,
        id_resp_h, host, user_agent, 'missing' AS anon_host FROM web""",
)
def scan_json_query(t: Tables):
    """Web logs written as gzip JSON by day, scanned back under a schema and cleaned."""
    root = shared_dir(t.spark, "json")
    (
        t.web().select(
            F.col("uid").cast("string").alias("uid"), F.col("ts").cast("double").alias("ts"),
            F.col("id_orig_h").cast("string").alias("id.orig_h"), F.col("id_resp_h").alias("id.resp_h"), "host",
            "user_agent", "day",
        ).write.partitionBy("day").option("compression", "gzip").json(root)
    )
    schema = "uid string, ts double, `id.orig_h` string, `id.resp_h` string, host string, user_agent string, anon_host string"
    return clean_log(scan_json(t.spark, [root], schema).drop("_source"))


@query("scan_csv", "SELECT c_custkey AS indicator, c_name AS description, c_acctbal AS balance FROM customer")
def scan_csv_query(t: Tables):
    root = shared_dir(t.spark, "csv")
    feed = t.table("customer").select(
        F.col("c_custkey").alias("indicator"), F.col("c_name").alias("description"), F.col("c_acctbal").alias("balance")
    )
    feed.write.option("header", True).csv(root)
    return scan_csv(t.spark, root, "indicator long, description string, balance double").drop("_source")


@query(
    "scan_reports",
    """SELECT 'd' || doc_id AS fqdn, CAST(quality + toxic AS INTEGER) AS positives, quality AS qualitylab_detected,
       toxic AS toxicnet_detected, CASE WHEN toxic = 0 THEN 'None' ELSE CASE doc_id % 8 WHEN 0 THEN 'A' || doc_id
       WHEN 1 THEN 'A"' || doc_id WHEN 2 THEN chr(128512) || doc_id WHEN 3 THEN '\\d' || doc_id WHEN 4 THEN 'hit' || doc_id
       WHEN 5 THEN chr(7) || doc_id WHEN 6 THEN '\\q, }' || doc_id ELSE 'it''s ' || doc_id END END AS toxicnet_result
       FROM labels WHERE quality + toxic > 0""",
)
def scan_reports(t: Tables):
    """Report files read back; incomplete, clean and repeated reports are dropped. Results use every form of a string."""
    root = shared_dir(t.spark, "reports")
    forms = (
        r"'\x41%s'", r"u'\101\"%s'", r"'\U0001F600%s'", r"r'\d%s'", r"""'hit' "%s" """, r"'\a%s',", r"'\q, }%s'", r'''"it's %s"''',
    )
    chosen = F.get(F.array(*[F.lit(f) for f in forms]), (F.col("doc_id") % 8).cast("int"))
    _report_lines(t, F.replace(chosen, F.lit("%s"), F.col("doc_id").cast("string"))).write.text(root)
    reports = parse_reports(t.spark.read.text(root), strict=True)
    return pivot_verdicts(reports).select("fqdn", "positives", "qualitylab_detected", "toxicnet_detected", "toxicnet_result")
