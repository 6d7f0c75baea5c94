"""History queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.operators import history
from flowloom.plans.queries.bindings import NAMED, Tables, query

EXPIRY = 3


def _history_sql(seen: str, keys: str, extra: str) -> str:
    join = " AND ".join(f"d.{k.strip()} = h.{k.strip()}" for k in keys.split(","))
    return f"""seen AS ({seen}), calendar AS (SELECT DISTINCT day FROM seen),
    around AS (SELECT {keys}, day, lead(day) OVER w AS nxt, lag(day) OVER w AS prev FROM seen WINDOW w AS (PARTITION BY {keys} ORDER BY day)),
    marked AS (SELECT *, CASE WHEN prev IS NULL OR (SELECT count(*) FROM calendar c WHERE c.day >= a.prev + {EXPIRY} AND c.day < a.day) > 0 THEN 1 ELSE 0 END AS fresh
      FROM around a),
    runs AS (SELECT *, sum(fresh) OVER (PARTITION BY {keys} ORDER BY day) AS run FROM marked),
    shown AS (SELECT {', '.join('r.' + k.strip() for k in keys.split(','))}, r.run, c.day, r.day AS lastseen_date
      FROM runs r JOIN calendar c ON c.day >= r.day AND c.day < r.day + {EXPIRY} AND (r.nxt IS NULL OR c.day < r.nxt)),
    firsts AS (SELECT {keys}, run, min(day) AS firstseen_date FROM runs GROUP BY ALL),
    hostdays AS (SELECT DISTINCT host, day FROM seen)
    SELECT day, {keys}, firstseen_date, lastseen_date,
      (SELECT count(*) FROM hostdays d WHERE d.host = s.host AND d.day BETWEEN s.firstseen_date AND s.day) AS count_since_firstseen,
      CAST(day - firstseen_date AS INTEGER) AS days_since_firstseen, CAST(day - lastseen_date AS INTEGER) AS days_since_lastseen{extra}
    FROM (SELECT * FROM shown JOIN firsts USING ({keys}, run)) s"""


@query(
    "daily_hosts",
    f"WITH {NAMED} SELECT DISTINCT day, host, user_agent FROM named WHERE host IS NOT NULL AND user_agent IS NOT NULL",
)
def daily_hosts(t: Tables):
    return history.daily_hosts(t.web(), "host", "user_agent", by=["day"])


@query(
    "domain_history",
    "WITH " + NAMED + ", " + _history_sql(
        "SELECT DISTINCT day, host, user_agent FROM named", "host, user_agent",
        ", 'HTTP' AS firstseen_log_type, 'HTTP' AS lastseen_log_type, CAST(0 AS INTEGER) AS \"isIP\"",
    ),
)
def domain_history(t: Tables):
    """Every day's history; the user agent plays the site tag, the expiry is three days."""
    seen = history.daily_hosts(t.web(), "host", "user_agent", by=["day"])
    return history.history_replay(seen, ["host", "user_agent"], expiry=EXPIRY)


@query(
    "periodicity_history",
    "WITH " + NAMED + ", " + _history_sql(
        "SELECT day, host FROM named GROUP BY day, host HAVING count(DISTINCT uid) > 8", "host", ""
    ),
)
def periodicity_history(t: Tables):
    """Hosts that were busy that day play the periodic ones."""
    busy = (
        history.daily_hosts(t.web(), "host", None, "id_resp_h", by=["day", "uid"])
        .groupBy("day", "host").agg(F.countDistinct("uid").alias("n")).where("n > 8")
    )
    return history.history_replay(busy.select("day", "host"), ["host"], log_type=None, expiry=EXPIRY)


@query(
    "domain_history_last",
    "WITH " + NAMED + ", h AS (WITH " + _history_sql(
        "SELECT DISTINCT day, host, user_agent FROM named", "host, user_agent", "",
    ) + ") SELECT * FROM h WHERE day = (SELECT max(day) FROM named)",
)
def domain_history_last(t: Tables):
    """The last day's history by one carried step over the day before."""
    seen = history.daily_hosts(t.web(), "host", "user_agent", by=["day"])
    last = t.web().agg(F.max("day")).first()[0]
    keys = ["host", "user_agent"]
    replay = history.history_replay(seen, keys, expiry=EXPIRY)
    before = replay.where(F.col("day") == F.date_sub(F.lit(last), 1)).drop("day")
    after = history.history_step(before, seen.where(F.col("day") == F.lit(last)), last, keys, expiry=EXPIRY)
    return after.select(F.lit(last).alias("day"), *[c for c in after.columns if c not in (
        "firstseen_log_type", "lastseen_log_type", "isIP")])
