"""Time-series queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.operators import periodicity, series
from flowloom.plans.queries.bindings import NAMED, Tables, query

KEYS = ["day", "host"]


def _cells_sql(source: str = "named", tag: str = "") -> str:
    return f"""first{tag} AS (SELECT day, uid, id_resp_h, host, min(ts) AS ts FROM {source} GROUP BY ALL),
    local{tag} AS (SELECT day, host, CAST(floor((epoch(date_trunc('second', (ts AT TIME ZONE 'UTC') AT TIME ZONE
        'America/New_York')) - epoch(day)) / 60) AS INTEGER) AS m FROM first{tag}),
    cells{tag} AS (SELECT day, host, CASE WHEN m BETWEEN 0 AND 1439 THEN m END AS minute, count(*) AS cnt
        FROM local{tag} GROUP BY ALL),
    series{tag} AS (SELECT day, host, count(minute) AS ts_cnt,
        coalesce(sum(CASE WHEN minute IS NOT NULL THEN cnt END), 0) AS total,
        coalesce(sum(minute * cnt), 0) AS moment FROM cells{tag} GROUP BY ALL)"""


def _checks(df, *extra):
    """Length, total and first moment of a series stand for the array."""
    moment = F.aggregate(F.transform("tdf", lambda x, i: (x * i).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return df.select(
        *KEYS, *extra, F.col("ts_cnt").cast("long").alias("ts_cnt"), F.size("tdf").alias("bins"),
        F.aggregate("tdf", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), moment.alias("moment"),
    )


@query(
    "build_ts",
    f"WITH {NAMED}, {_cells_sql()} SELECT day, host, ts_cnt, CAST(1440 AS INTEGER) AS bins, CAST(total AS BIGINT) AS total, CAST(moment AS BIGINT) AS moment FROM series",
)
def build_ts(t: Tables):
    return _checks(series.build_series(t.web()))


@query(
    "minute_cells",
    f"WITH {NAMED}, {_cells_sql()} SELECT day, host, minute, CAST(cnt AS INTEGER) AS cnt FROM cells",
)
def minute_cells(t: Tables):
    return series.minute_cells(t.web())


HALVES = f"""{NAMED}, a AS (SELECT * FROM named WHERE uid % 2 = 0), b AS (SELECT * FROM named WHERE uid % 2 = 1),
  {_cells_sql('a', '_a')}, {_cells_sql('b', '_b')}"""


def _halves(t: Tables):
    """Even connections play one protocol or site, odd ones the other."""
    web = t.web()
    return [series.build_series(web.where(F.col("uid") % 2 == i)) for i in (0, 1)]


@query(
    "merge_ts",
    f"""WITH {HALVES}, spots AS (SELECT day, host, count(DISTINCT minute) AS n
        FROM (FROM cells_a UNION ALL FROM cells_b) GROUP BY ALL)
    SELECT day, host, CAST(a.ts_cnt AS INTEGER) AS ts_cnt_http, CAST(b.ts_cnt AS INTEGER) AS ts_cnt_ssl, n AS ts_cnt,
      CAST(1440 AS INTEGER) AS bins, CAST(coalesce(a.total, 0) + coalesce(b.total, 0) AS BIGINT) AS total,
      CAST(coalesce(a.moment, 0) + coalesce(b.moment, 0) AS BIGINT) AS moment
    FROM series_a a FULL JOIN series_b b USING (day, host) JOIN spots USING (day, host)""",
)
def merge_ts(t: Tables):
    return _checks(series.merge_protocols(*_halves(t)), "ts_cnt_http", "ts_cnt_ssl")


@query(
    "agg_ts",
    f"""WITH {HALVES} SELECT day, host, a.ts_cnt + b.ts_cnt AS ts_cnt, CAST(1440 AS INTEGER) AS bins,
      CAST(a.total + b.total AS BIGINT) AS total, CAST(a.moment + b.moment AS BIGINT) AS moment
    FROM series_a a JOIN series_b b USING (day, host)""",
)
def agg_ts(t: Tables):
    return _checks(series.merge_sites(*_halves(t)))


GAPS = """gaps AS (SELECT * FROM (SELECT day, host, minute, minute - lag(minute) OVER (PARTITION BY day, host
  ORDER BY minute) AS gap FROM cells WHERE minute IS NOT NULL) WHERE gap IS NOT NULL)"""


@query("interarrival", f"WITH {NAMED}, {_cells_sql()}, {GAPS} SELECT day, host, minute, gap FROM gaps")
def interarrival(t: Tables):
    return series.gaps(series.minute_cells(t.web()), KEYS)


@query(
    "gap_profile",
    f"""WITH {NAMED}, {_cells_sql()}, {GAPS} SELECT day, host, count(gap) AS n_gaps, min(gap) AS min_tsinterval,
      round(avg(gap), 6) AS mean_gap, round(var_samp(gap), 4) AS var_gap FROM gaps GROUP BY ALL""",
)
def gap_profile(t: Tables):
    out = series.gap_profile(series.minute_cells(t.web()), KEYS)
    return out.withColumns({"mean_gap": F.round("mean_gap", 6), "var_gap": F.round("var_gap", 4)})


@query(
    "autocorr",
    f"""WITH {NAMED}, {_cells_sql()} SELECT day, host, b.minute - a.minute AS lag, CAST(sum(a.cnt * b.cnt) AS BIGINT) AS acf
    FROM cells a JOIN cells b USING (day, host) WHERE b.minute > a.minute GROUP BY ALL""",
)
def autocorr(t: Tables):
    """Non-zero autocorrelation by lag."""
    acf = periodicity.with_autocorrelation(series.build_series(t.web()))
    return acf.select(*KEYS, F.posexplode("acf").alias("lag", "acf")).where("acf > 0")


SPECTRUM = """psd AS (
  SELECT day, host, k, (CASE WHEN k < 720 THEN 2 ELSE 1 END) / 1440
    * (power(sum(cnt * cos(2 * pi() * k * minute / 1440)), 2) + power(sum(cnt * sin(2 * pi() * k * minute / 1440)), 2)) AS power
  FROM cells, generate_series(1, 720) f(k) WHERE minute IS NOT NULL GROUP BY day, host, k),
  noise AS (SELECT day, host, avg(power) AS mean, max(power) AS top,
    -avg(power) * ln(1 - power(0.95, CAST(1 AS DOUBLE) / 720)) AS threshold FROM psd GROUP BY ALL)"""


@query(
    "periodogram",
    f"WITH {NAMED}, {_cells_sql()}, {SPECTRUM} SELECT day, host, round(mean, 6) AS mean_psd, round(top, 6) AS max_psd, round(threshold, 6) AS threshold FROM noise",
)
def periodogram(t: Tables):
    """Mean and peak power of every series with activity, and the noise threshold."""
    spectra = periodicity.with_spectrum(series.build_series(t.web()).where("ts_cnt > 0"))
    return spectra.select(
        *KEYS, F.round("psd_mean", 6).alias("mean_psd"), F.round("psd_max", 6).alias("max_psd"),
        F.round(periodicity.noise_threshold(), 6).alias("threshold"),
    )


@query(
    "candidate_periods",
    f"""WITH {NAMED}, {_cells_sql()}, {SPECTRUM} SELECT day, host, CAST(k AS INTEGER) AS k, round(power, 6) AS power,
      round(CAST(1440 AS DOUBLE) / k, 6) AS period FROM psd JOIN noise USING (day, host) WHERE power > -mean * ln(1 - power(0.3, CAST(1 AS DOUBLE) / 720)) AND k > 2""",
)
def candidate_periods(t: Tables):
    """Random events hardly pass 0.95, so 0.3 is asked for."""
    spectra = periodicity.with_spectrum(series.build_series(t.web()).where("ts_cnt > 0"))
    found = periodicity.candidate_periods(spectra, KEYS, confidence=0.3)
    return found.select(*KEYS, "k", F.round("power", 6).alias("power"), F.round("period", 6).alias("period"))


@query(
    "period_t_test",
    f"""WITH {NAMED}, {_cells_sql()}, {GAPS}, p AS (SELECT day, host, count(gap) AS n, min(gap) AS period, avg(gap) AS mean,
        coalesce(var_samp(gap), 0) AS var FROM gaps GROUP BY ALL),
    tt AS (SELECT day, host, n + 18 AS v, (period - mean) / sqrt(((n - 1) * var + 1900) / (n + 18) * (1 / n + 0.05)) AS t FROM p),
    parts AS (SELECT *, atan(abs(t) / sqrt(v)) AS a FROM tt),
    sums AS (SELECT day, host, t, v, a, sum(exp(lgamma(j + 1) + lgamma(1.5) - lgamma(j + 1.5)) * power(cos(a), 2 * j + 1)) AS odd,
        sum(exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1)) * power(cos(a), 2 * j)) AS even
      FROM (SELECT *, unnest(range(v // 2)) AS j FROM parts) GROUP BY ALL),
    tails AS (SELECT day, host, t, CASE WHEN v % 2 = 1 THEN 2 / pi() * (a + sin(a) * odd) ELSE sin(a) * even END AS inside FROM sums)
    SELECT day, host, round(t, 6) AS t_value, round(1 - inside, 6) AS p_value, 1 - inside > 0.05 AS kept, 1 - inside > 0.01 AS kept_01 FROM tails""",
)
def period_t_test(t: Tables):
    """Does the smallest gap explain the gaps, at 5 and at 1 percent?"""
    profile = series.gap_profile(series.minute_cells(t.web()), KEYS).withColumn("period", F.col("min_tsinterval").cast("double"))
    tested = periodicity.period_t(profile)
    strict = periodicity.period_t(profile, alpha=0.01).select(*KEYS, F.col("kept").alias("kept_01"))
    rounded = (F.round(c, 6).alias(c) for c in ("t_value", "p_value"))
    return tested.select(*KEYS, *rounded, "kept").join(strict, KEYS)
