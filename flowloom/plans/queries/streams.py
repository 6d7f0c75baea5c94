"""Streaming queries: the stream is read to its end, the closed windows are compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.plans.queries.bindings import NAMED, WEB, Tables, query
from flowloom.plans.slots import DAY
from flowloom.plans.store import SlotStore
from flowloom.session import shared_dir
from flowloom.streaming.stored import store_windows
from flowloom.streaming.twins import sliding_extremes, streaming_history, tumbling_hosts


def _stream(t: Tables, folder: str | None = None) -> DataFrame:
    """Events as a stream of files, under log names; those of ``folder`` if one is named."""
    source = t.spark.readStream.schema(t.table("events").schema)
    source = source.parquet(folder) if folder else source.option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return source.select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("id_orig_h"),
        F.col("event_type").alias("user_agent"),
        F.when(k % 10 == 0, "").otherwise(F.concat(F.lit("h"), k % 40, F.lit(".example.com"))).alias("host"),
        F.concat(F.lit("10.0."), k % 7, F.lit("."), k).alias("id_resp_h"),
    )


def _drain(t: Tables, stream: DataFrame, purpose: str) -> DataFrame:
    """Run the stream over what is there and read back what it wrote."""
    root = shared_dir(t.spark, purpose)
    run = (
        stream.writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(f"{root}/out")


CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM web)"


@query(
    "stream_tumbling",
    f"""WITH {NAMED} SELECT day, host, count(DISTINCT id_orig_h) AS cnt_distinct_hosts, count(id_orig_h) AS cnt_logs
        FROM named WHERE day + INTERVAL 1 DAY <= {CLOSED} GROUP BY day, host""",
)
def stream_tumbling(t: Tables):
    out = _drain(t, tumbling_hosts(_stream(t)), "tumbling")
    return out.select(F.col("window.start").cast("date").alias("day"), "host", "cnt_distinct_hosts", "cnt_logs")


@query(
    "stream_sliding",
    f"""WITH {WEB}, daily AS (SELECT day, user_agent, count(*) AS n FROM web GROUP BY ALL),
    starts AS (SELECT DISTINCT CAST(day - CAST(i AS INTEGER) AS DATE) AS start FROM daily, generate_series(0, 4) f(i))
    SELECT start, user_agent, min(n) AS min5day_cnt_logs, max(n) AS max5day_cnt_logs
    FROM starts JOIN daily ON day BETWEEN start AND start + 4
    WHERE start + INTERVAL 5 DAY <= {CLOSED} GROUP BY start, user_agent""",
)
def stream_sliding(t: Tables):
    out = _drain(t, sliding_extremes(_stream(t), host="user_agent"), "sliding")
    return out.select(F.col("window.start").cast("date").alias("start"), "user_agent", "min5day_cnt_logs", "max5day_cnt_logs")


@query(
    "stream_history",
    f"""WITH {NAMED}, seen AS (SELECT DISTINCT host, user_agent, day FROM named WHERE day + INTERVAL 1 DAY <= {CLOSED}),
    marked AS (SELECT *, CASE WHEN lag(day) OVER w IS NULL OR day - lag(day) OVER w > 3 THEN 1 ELSE 0 END AS fresh
      FROM seen WINDOW w AS (PARTITION BY host, user_agent ORDER BY day)),
    runs AS (SELECT *, sum(fresh) OVER (PARTITION BY host, user_agent ORDER BY day) AS run FROM marked)
    SELECT host, user_agent, day, min(day) OVER r AS firstseen_date, day AS lastseen_date,
      row_number() OVER r AS count_since_firstseen
    FROM runs WINDOW r AS (PARTITION BY host, user_agent, run ORDER BY day)""",
)
def stream_history(t: Tables):
    logs = _stream(t).withColumn(
        "host", F.when(F.col("host") == "", F.concat(F.lit("missing_"), "id_resp_h")).otherwise(F.col("host"))
    )
    return _drain(t, streaming_history(logs, ["host", "user_agent"], expiry=3), "history")


@query(
    "stream_store",
    f"""WITH {NAMED}, closed AS (SELECT * FROM named WHERE day + INTERVAL 1 DAY <= {CLOSED}),
    hosts AS (SELECT day, host, count(DISTINCT id_orig_h) AS cnt_distinct_hosts, count(id_orig_h) AS cnt_logs FROM closed GROUP BY ALL),
    slots AS (SELECT CAST(unnest(range(CAST(min(day) AS TIMESTAMP), max(day) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM closed)
    SELECT s.day, host, cnt_distinct_hosts, cnt_logs, count(host) OVER (PARTITION BY s.day) AS rows FROM slots s LEFT JOIN hosts h ON h.day = s.day""",
)
def stream_store(t: Tables):
    """A stream stops half-way, starts again from its checkpoint, and its windows are read as slots, beside what the manifest says."""
    root, events = shared_dir(t.spark, "stored"), t.table("events")
    store = SlotStore(t.spark, f"{root}/slots")
    ends = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).select(F.timestamp_seconds(
        ((F.unix_timestamp("low") + F.unix_timestamp("high")) / 2).cast("long")).cast("timestamp_ntz").alias("middle"))
    (middle,) = ends.first()
    for part in (events.where(F.col("ts") < F.lit(middle)), events.where(F.col("ts") >= F.lit(middle))):
        part.write.mode("append").parquet(f"{root}/events")
        run = store_windows(tumbling_hosts(_stream(t, f"{root}/events")), store, "hosts", DAY, f"{root}/checkpoint", available_now=True)
        run.awaitTermination()
    rows = store.read("hosts", store.slots_of("hosts")).withColumn("day", F.col("slot_start").cast("date"))
    declared = store.manifest("hosts").select(F.timestamp_seconds("start_epoch").cast("date").alias("day"), "rows")
    return declared.join(rows, "day", "left").select("day", "host", "cnt_distinct_hosts", "cnt_logs", "rows")
