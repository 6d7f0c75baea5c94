"""Queries of row-set operators, slots and reputation reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowloom.functions.scores import detection_ratio
from flowloom.operators import tables
from flowloom.plans.coverage import coverage_ranges, mark_slots
from flowloom.plans.queries.bindings import WEB, Tables, query
from flowloom.plans.slots import from_epoch, moment_lit, month_table, slot_table
from flowloom.sources.reports import parse_reports, pivot_verdicts, section_average


def _people(t: Tables):
    customer = t.table("customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    supplier = t.table("supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey")
    )
    return customer, supplier


@query(
    "concat_common",
    """SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
       UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier""",
)
def concat_common(t: Tables):
    return tables.concat_common(*_people(t))


@query(
    "concat_missing",
    """SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL FROM supplier""",
)
def concat_missing(t: Tables):
    return tables.concat_all(*_people(t))


@query("trim_columns", "SELECT c_name, c_acctbal FROM customer")
def trim_columns(t: Tables):
    return tables.trim_columns(t.table("customer"), ["c_name", "c_acctbal"])


@query("drop_arrays", "SELECT vec_id, label FROM embeddings")
def drop_arrays(t: Tables):
    return tables.drop_arrays(t.table("embeddings"))


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(t: Tables):
    return t.table("lineitem").select("l_suppkey", "l_returnflag").distinct()


@query(
    "keep_one",
    """SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (
       PARTITION BY l_suppkey, l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey) AS n FROM lineitem) WHERE n = 1""",
)
def keep_one(t: Tables):
    rows = t.table("lineitem").select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey")
    return tables.keep_one(rows, ["l_suppkey", "l_returnflag"], ["l_orderkey", "l_linenumber", "l_partkey"])


@query(
    "topk",
    """SELECT o_totalprice, o_orderkey, o_orderstatus FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 42""",
)
def topk(t: Tables):
    return tables.top_k(t.table("orders"), "o_totalprice", ["o_orderkey", "o_orderstatus"], ties=["o_orderkey"])


def _bounds(web):
    """First and last half-hour edge around the log."""
    lo, hi = web.agg(F.unix_timestamp(F.min("ts")), F.unix_timestamp(F.max("ts"))).first()
    return from_epoch(lo // 1800 * 1800), from_epoch(hi // 1800 * 1800 + 1800)


@query(
    "tile_slots",
    f"""WITH {WEB}, bounds AS (SELECT time_bucket(INTERVAL 30 MINUTE, min(ts)) AS lo, time_bucket(INTERVAL 30 MINUTE, max(ts)) AS hi FROM web),
    slots AS (SELECT unnest(generate_series(lo, hi, INTERVAL 30 MINUTE)) AS slot FROM bounds)
    SELECT CAST(epoch(slot) AS BIGINT) AS slot_epoch, count(event_id) AS n FROM slots
    LEFT JOIN web ON time_bucket(INTERVAL 30 MINUTE, ts) = slot GROUP BY slot""",
)
def tile_slots(t: Tables):
    """Half-hour slots over the range of the log, with their rows."""
    web = t.web()
    counted = web.groupBy(F.window("ts", "30 minutes")["start"].alias("slot_start")).agg(F.count(F.lit(1)).alias("n"))
    slots = slot_table(t.spark, *_bounds(web), 1800).join(counted, "slot_start", "left")
    return slots.select(F.unix_timestamp("slot_start").alias("slot_epoch"), F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "month_slots",
    """WITH bounds AS (SELECT date_trunc('month', min(o_orderdate)) AS lo, date_trunc('month', max(o_orderdate)) AS hi FROM orders),
    slots AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM bounds)
    SELECT month, count(o_orderkey) AS n FROM slots LEFT JOIN orders ON date_trunc('month', o_orderdate) = month GROUP BY month""",
)
def month_slots(t: Tables):
    orders = t.table("orders").withColumn("ts", F.col("o_orderdate").cast("timestamp"))
    counted = orders.groupBy(F.date_trunc("month", "ts").alias("slot_start")).agg(F.count(F.lit(1)).alias("n"))
    lo, hi = orders.agg(F.unix_timestamp(F.min("ts")), F.unix_timestamp(F.max("ts"))).first()
    slots = month_table(t.spark, from_epoch(lo), from_epoch(hi)).join(counted, "slot_start", "left")
    return slots.select(F.col("slot_start").cast("date").alias("month"), F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "coverage",
    f"""WITH {WEB}, bounds AS (SELECT time_bucket(INTERVAL 30 MINUTE, min(ts)) AS lo, time_bucket(INTERVAL 30 MINUTE, max(ts)) AS hi FROM web),
    slots AS (SELECT unnest(generate_series(lo, hi, INTERVAL 30 MINUTE)) AS slot FROM bounds),
    kinds AS (SELECT DISTINCT user_agent AS feature FROM web),
    marked AS (SELECT feature, slot, EXISTS (FROM web WHERE user_agent = feature AND time_bucket(INTERVAL 30 MINUTE, ts) = slot) AS present
      FROM kinds, slots),
    islands AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY slot)
      - row_number() OVER (PARTITION BY feature, present ORDER BY slot) AS island FROM marked)
    SELECT feature, present, CAST(epoch(min(slot)) AS BIGINT) AS start_epoch, CAST(epoch(max(slot)) + 1800 AS BIGINT) AS end_epoch,
      count(*) AS slots FROM islands GROUP BY feature, present, island""",
)
def coverage(t: Tables):
    """Runs of half-hour slots with and without events of each type."""
    web = t.web()
    present = web.select(
        F.col("user_agent").alias("feature"), F.window("ts", "30 minutes")["start"].alias("slot_start")
    ).distinct()
    names = present.select("feature").distinct()
    lo, hi = [moment_lit(m) for m in _bounds(web)]
    marked = mark_slots(names, lo, hi, 1800, present)
    ranges = coverage_ranges(marked)
    return ranges.select(
        "feature", "present", F.unix_timestamp("range_start").alias("start_epoch"),
        F.unix_timestamp("range_end").alias("end_epoch"), "slots",
    )


@query(
    "reputation_ratio",
    """SELECT doc_id, CASE WHEN quality + toxic = 0 THEN CAST(0 AS DOUBLE) ELSE round(toxic / (quality + toxic), 6) END AS ratio
       FROM labels""",
)
def reputation_ratio(t: Tables):
    ratio = detection_ratio("toxic", F.col("quality") + F.col("toxic"))
    return t.table("labels").select("doc_id", F.round(ratio, 6).alias("ratio"))


def _report_lines(t: Tables, toxic_result: Column | None = None):
    """Labels written as report lines, every label a vendor's verdict; ``toxic_result`` is how one result is written."""
    hit = F.concat(F.lit("'hit"), F.col("doc_id") % 3, F.lit("'"))
    verdict = lambda c, result: F.concat(
        F.lit("{'detected': "), F.when(F.col(c) == 1, "True").otherwise("False"), F.lit(", 'result': "),
        F.when(F.col(c) == 1, result).otherwise("None"), F.lit("}"),
    )
    return t.table("labels").select(
        F.concat(
            F.lit("{'query': 'd"), F.col("doc_id"), F.lit("', 'query_date': '2024-01-01', 'positives': "),
            F.col("quality") + F.col("toxic"), F.lit(", 'total': 2, 'scans': {'Quality Lab!': "), verdict("quality", hit),
            F.lit(", 'Toxic-Net': "), verdict("toxic", hit if toxic_result is None else toxic_result), F.lit("}}"),
        ).alias("value")
    )


@query(
    "verdict_pivot",
    """SELECT 'd' || doc_id AS fqdn, '2024-01-01' AS date, CAST(quality + toxic AS INTEGER) AS positives,
       CAST(2 AS INTEGER) AS total, quality AS qualitylab_detected, toxic AS toxicnet_detected,
       CASE WHEN quality = 1 THEN 'hit' || (doc_id % 3) ELSE 'None' END AS qualitylab_result,
       CASE WHEN toxic = 1 THEN 'hit' || (doc_id % 3) ELSE 'None' END AS toxicnet_result FROM labels""",
)
def verdict_pivot(t: Tables):
    reports = parse_reports(_report_lines(t))
    return pivot_verdicts(reports, ["qualitylab", "toxicnet"])


@query(
    "report_sections",
    """SELECT source AS report, lang AS section, round_even(avg(toxic), 1) AS positives, round_even(avg(quality + toxic), 1) AS total
       FROM documents JOIN labels USING (doc_id) GROUP BY ALL""",
)
def report_sections(t: Tables):
    """Average detections per source and language."""
    docs = t.table("documents").select("doc_id", "source", "lang").join(t.table("labels"), "doc_id")
    return section_average(
        docs.select(F.col("source").alias("report"), F.col("lang").alias("section"), F.col("toxic").alias("positives"),
                    (F.col("quality") + F.col("toxic")).alias("total")),
        ["report", "section"],
    )
