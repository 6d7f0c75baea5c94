"""Log-like views of the provided tables, in Spark and in SQL, and the query registry.

The tables stand in for logs: events for web logs, lineitem for connections, orders for TLS records,
part for certificates, customer for a blacklist, nation for rank lists and address ranges.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.session import configure, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, if SQL can express it, the SQL with the same result."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(Tables(configure(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def web(self) -> DataFrame:
        # k has a step of its own: it is used several times and parsed once.
        parsed = self.table("events").withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("int"))
        k = F.col("k")
        return parsed.select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("ts").cast("date").alias("day"),
            F.col("user_id").alias("id_orig_h"),
            F.col("event_type").alias("user_agent"),
            "value",
            "k",
            F.floor(F.col("event_id") / 2).alias("uid"),
            F.when(k % 10 == 0, "").otherwise(F.concat(F.lit("h"), k % 40, F.lit(".example.com"))).alias("host"),
            F.concat(F.lit("10.0."), k % 7, F.lit("."), k).alias("id_resp_h"),
        )

    def conn(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("uid"),
            F.col("l_shipdate").cast("timestamp").alias("ts"),
            (F.col("l_partkey") % 400).alias("id_orig_h"),
            F.col("l_suppkey").alias("id_resp_h"),
            F.when(F.col("l_suppkey") % 2 == 0, 443).otherwise(80).alias("id_resp_p"),
            F.when(F.col("l_returnflag") == "A", "SF").when(F.col("l_returnflag") == "N", "S1")
            .otherwise("RSTOS0").alias("conn_state"),
            F.col("l_quantity").alias("duration"),
            F.col("l_extendedprice").alias("orig_bytes"),
            F.round(F.col("l_discount") * 100).cast("long").alias("resp_bytes"),
            F.col("l_linestatus").alias("proto"),
            "l_linenumber", "l_partkey",
        )

    def ssl(self) -> DataFrame:
        """Orders of status P have no TLS record."""
        return self.table("orders").where(F.col("o_orderstatus") != "P").select(
            F.col("o_orderkey").alias("uid"),
            F.when(F.col("o_orderstatus") == "F", "T").otherwise("F").alias("established"),
            F.col("o_orderpriority").alias("cipher"),
        )

    def cert(self) -> DataFrame:
        size = F.col("p_size")
        extra = (
            F.when(size % 5 == 0, ',O=Twin "Trust" LLC').when(size % 5 == 1, ", ST=XX")
            .when(size % 5 == 2, ",L=a=b").when(size % 5 == 3, ",ST=North").otherwise("")
        )
        org = F.when(size == 50, "").otherwise(F.concat(F.lit(",O="), F.col("p_brand"), F.lit(" Inc.")))
        dn = F.concat(F.lit("CN="), F.col("p_name"), org, F.lit(",C="), size, extra)
        before = F.timestamp_add("DAY", size, F.lit("2020-01-01 00:00:00").cast("timestamp"))
        return self.table("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_partkey").cast("string").alias("certificate_serial"),
            dn.alias("certificate_subject"),
            F.concat(F.lit("CN="), F.col("p_brand"), org).alias("certificate_issuer"),
            before.alias("certificate_not_valid_before"),
            F.timestamp_add("SECOND", size * 2592000 + F.col("p_partkey"), before).alias("certificate_not_valid_after"),
            F.array(
                F.concat(F.lower("p_type"), F.lit(".example.com")), F.lit("www.shop.co.uk")
            ).alias("san_dns"),
            size.alias("p_size"),
        )

    def chains(self) -> DataFrame:
        """One TLS connection per order: its parts by (line number, part key) are the chain."""
        links = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))
        return (
            self.table("lineitem").groupBy(F.col("l_orderkey").alias("uid"))
            .agg(links.alias("_links"))
            .select("uid", F.col("_links.l_partkey").alias("cert_chain_fuids"))
            .withColumn("cert_chain_fuids_len", F.size("cert_chain_fuids"))
        )


WEB = """web AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS day, user_id AS id_orig_h, event_type AS user_agent, value, k,
         CAST(event_id // 2 AS BIGINT) AS uid,
         CASE WHEN k % 10 = 0 THEN '' ELSE concat('h', k % 40, '.example.com') END AS host,
         concat('10.0.', k % 7, '.', k) AS id_resp_h
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events))"""

# Web logs whose blank hosts are named after their address.
NAMED = WEB + """, named AS (
  SELECT * EXCLUDE (host), CASE WHEN host IN ('missing', '') THEN 'missing_' || id_resp_h ELSE host END AS host
  FROM web)"""

CONN = """conn AS (
  SELECT l_orderkey AS uid, l_shipdate AS ts, l_partkey % 400 AS id_orig_h, l_suppkey AS id_resp_h,
         CASE WHEN l_suppkey % 2 = 0 THEN 443 ELSE 80 END AS id_resp_p,
         CASE l_returnflag WHEN 'A' THEN 'SF' WHEN 'N' THEN 'S1' ELSE 'RSTOS0' END AS conn_state,
         l_quantity AS duration, l_extendedprice AS orig_bytes,
         CAST(round(l_discount * 100) AS BIGINT) AS resp_bytes, l_linestatus AS proto, l_linenumber, l_partkey
  FROM lineitem)"""

SSL = """ssl AS (
  SELECT o_orderkey AS uid, CASE WHEN o_orderstatus = 'F' THEN 'T' ELSE 'F' END AS established,
         o_orderpriority AS cipher
  FROM orders WHERE o_orderstatus <> 'P')"""

CERT = """cert AS (
  SELECT p_partkey AS id, CAST(p_partkey AS VARCHAR) AS certificate_serial,
         'CN=' || p_name || org || ',C=' || p_size ||
           CASE p_size % 5 WHEN 0 THEN ',O=Twin "Trust" LLC' WHEN 1 THEN ', ST=XX' WHEN 2 THEN ',L=a=b'
                           WHEN 3 THEN ',ST=North' ELSE '' END AS certificate_subject,
         'CN=' || p_brand || org AS certificate_issuer,
         TIMESTAMP '2020-01-01' + to_days(p_size) AS nvb,
         TIMESTAMP '2020-01-01' + to_days(p_size) + to_seconds(p_size * 2592000 + p_partkey) AS nva,
         lower(p_type) || '.example.com' AS san1, p_size
  FROM (SELECT *, CASE WHEN p_size = 50 THEN '' ELSE ',O=' || p_brand || ' Inc.' END AS org FROM part))"""

CHAIN = """chain AS (
  SELECT l_orderkey AS uid, l_partkey AS cert_id,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS pos,
         count(*) OVER (PARTITION BY l_orderkey) AS len
  FROM lineitem)"""


def dn_sql(dn: str, key: str, default: str = "''") -> str:
    """SQL for the value of ``key`` in the last well-formed part of a DN."""
    return (
        f"coalesce(string_split(list_filter(string_split({dn}, ','), lambda p: "
        f"len(string_split(p, '=')) = 2 AND string_split(p, '=')[1] = '{key}')[-1], '=')[2], {default})"
    )


def ca_sql(text: str) -> str:
    """SQL for a CA name cut at legal suffixes, one after the other."""
    out = f"replace(replace({text}, '\\', ''), '\"', '')"
    for s in (" Inc", " INC", " L.L.C.", " LLC", " llc", " Co.", " CO.", " Ltd", " Limited", " GmbH"):
        out = f"string_split({out}, '{s}')[1]"
    return out
