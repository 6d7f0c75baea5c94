"""Queries of period detection: noise threshold by shuffles, peaks, low-pass re-check and the whole chain.

The SQL goes another way than the library where it can: sums of cosines for the fast Fourier transform, a recursion over
the bins for the filter, joins for peaks and prominence.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from flowloom.operators import periodicity, series, spectral
from flowloom.plans.queries.bindings import NAMED, Tables, query
from flowloom.plans.queries.series import HALVES, KEYS, _cells_sql, _halves

PERMS = f"""perms AS MATERIALIZED (SELECT p, bin, row_number() OVER (PARTITION BY p ORDER BY md5(p || ':' || bin)) - 1 AS place
  FROM range({spectral.PERMUTATIONS}) a(p), range(1440) b(bin))"""
RANK = int(spectral.CONFIDENCE * spectral.PERMUTATIONS)

# Highest power of each shuffle of each series, and the threshold; cells: the non-zero bins of the series.
THRESHOLD = f"""{PERMS},
spots AS MATERIALIZED (SELECT day, host, p, list({{'m': place, 'c': cnt}}) AS held FROM cells JOIN active USING (day, host) JOIN perms ON bin = minute
  WHERE minute IS NOT NULL GROUP BY ALL),
tops AS (SELECT day, host, p, list_max(list_transform(range(1, 721), lambda k: (CASE WHEN k < 720 THEN 2 ELSE 1 END) / 1440
  * (power(list_sum(list_transform(held, lambda x: x.c * cos(2 * pi() * ((k * x.m) % 1440) / 1440))), 2)
   + power(list_sum(list_transform(held, lambda x: x.c * sin(2 * pi() * ((k * x.m) % 1440) / 1440))), 2)))) AS top FROM spots),
limits AS MATERIALIZED (SELECT day, host, top AS threshold FROM (SELECT *, row_number() OVER (PARTITION BY day, host ORDER BY top) AS place FROM tops) WHERE place = {RANK})"""

ACTIVE = "active AS MATERIALIZED (SELECT day, host, ts_cnt FROM series WHERE ts_cnt > 2)"


def _peaks_sql(tag: str, dense: str, key: str) -> str:
    """(key, spot) of the prominent peaks of the curves ``dense`` (key, lag, v)."""
    return f"""
turns{tag} AS (SELECT *, coalesce(v <> lag(v) OVER (PARTITION BY {key} ORDER BY lag), TRUE) AS turn FROM {dense}),
numbered{tag} AS (SELECT *, sum(turn::INT) OVER (PARTITION BY {key} ORDER BY lag) AS run FROM turns{tag}),
runs{tag} AS (SELECT {key}, run, min(lag) AS s, max(lag) AS e, any_value(v) AS v FROM numbered{tag} GROUP BY {key}, run),
sides{tag} AS (SELECT *, lag(v) OVER (PARTITION BY {key} ORDER BY run) AS before, lead(v) OVER (PARTITION BY {key} ORDER BY run) AS after FROM runs{tag}),
lows{tag} AS (SELECT {key}, min(v) AS low FROM {dense} GROUP BY {key}),
tops{tag} AS (SELECT {key}, (s + e) // 2 AS spot, v FROM sides{tag} JOIN lows{tag} USING ({key}) WHERE v > before AND v > after AND v - low >= {spectral.PROMINENCE}),
walls{tag} AS (SELECT {key}, spot, any_value(t.v) AS v, coalesce(max(lag) FILTER (lag < spot AND d.v > t.v), -1) AS a, coalesce(min(lag) FILTER (lag > spot AND d.v > t.v), 1440) AS b
  FROM tops{tag} t JOIN {dense} d USING ({key}) GROUP BY {key}, spot),
peaks{tag} AS MATERIALIZED (SELECT {key}, spot FROM (SELECT {key}, spot, any_value(w.v) AS v, min(d.v) FILTER (lag > a AND lag <= spot) AS left_low,
  min(d.v) FILTER (lag >= spot AND lag < b) AS right_low FROM walls{tag} w JOIN {dense} d USING ({key}) GROUP BY {key}, spot)
  WHERE v - greatest(left_low, right_low) >= {spectral.PROMINENCE})"""


# The autocorrelation of the active series by lag, scaled to 1.
CURVES = """chosen AS MATERIALIZED (SELECT DISTINCT day, host FROM {}),
pairs AS (SELECT day, host, b.minute - a.minute AS lag, sum(a.cnt * b.cnt) AS acf FROM cells a JOIN cells b USING (day, host) JOIN chosen USING (day, host)
  WHERE b.minute > a.minute GROUP BY ALL),
heights AS (SELECT day, host, max(acf) AS top FROM pairs GROUP BY ALL),
curves AS MATERIALIZED (SELECT day, host, g.lag, coalesce(acf, 0) / top AS v FROM heights CROSS JOIN range(1440) g(lag)
  LEFT JOIN pairs USING (day, host, lag))"""

PSD = """power AS (SELECT day, host, k, (CASE WHEN k < 720 THEN 2 ELSE 1 END) / 1440
  * (power(sum(cnt * cos(2 * pi() * k * minute / 1440)), 2) + power(sum(cnt * sin(2 * pi() * k * minute / 1440)), 2)) AS psd
  FROM cells JOIN active USING (day, host), generate_series(1, 720) f(k) WHERE minute IS NOT NULL GROUP BY day, host, k),
found AS MATERIALIZED (SELECT day, host, k, 1440::DOUBLE / k AS period FROM power JOIN limits USING (day, host) WHERE psd > threshold * (1 + 1e-9) AND k > 2),
gaps AS (SELECT day, host, min(gap) AS min_gap FROM (SELECT day, host, minute - lag(minute) OVER (PARTITION BY day, host ORDER BY minute) AS gap
  FROM cells WHERE minute IS NOT NULL) GROUP BY ALL HAVING min(gap) IS NOT NULL),
pruned AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY day, host, k) AS id FROM found JOIN gaps USING (day, host) WHERE period >= min_gap)"""


def _filter_sql() -> str:
    """filtered(id, t, v): each pruned period's series through second-order sections, bin by bin."""
    n = spectral.FILTER_ORDER
    halves = range(n // 2)
    parts = []
    for k in halves:
        damping = 2 * math.sin(math.pi * (2 * k + 1) / (2 * n))
        scale = f"(1 + {damping!r} * w + w * w)"
        parts.append(f"w * w / {scale} AS g{k}, 2 * (w * w - 1) / {scale} AS a{k}, (1 - {damping!r} * w + w * w) / {scale} AS c{k}")
    outs, states = [], []
    for k in halves:
        x = "xs[f.t + 2]" if k == 0 else f"y{k - 1}"
        outs.append(f"g{k} * {x} + u{k} AS y{k}")
        states.append(f"2 * g{k} * {x} - a{k} * y{k} + v{k} AS nu{k}, g{k} * {x} - c{k} * y{k} AS nv{k}")
    names = [c for k in halves for c in (f"u{k}", f"v{k}")]
    last = n // 2 - 1
    return f"""
gains AS MATERIALIZED (SELECT id, day, host, {", ".join(parts)} FROM (SELECT *, tan(pi() * (period + 1) / {spectral.FILTER_RATE}) AS w FROM pruned)),
arrays AS MATERIALIZED (SELECT g.id, list(coalesce(cnt, 0)::DOUBLE ORDER BY b.bin) AS xs FROM gains g CROSS JOIN range(1440) b(bin)
  LEFT JOIN cells c ON c.day = g.day AND c.host IS NOT DISTINCT FROM g.host AND c.minute = b.bin GROUP BY g.id),
steps(id, t, {", ".join(names)}, y) AS (SELECT id, -1, {", ".join("0::DOUBLE" for _ in names)}, 0::DOUBLE FROM gains
  UNION ALL SELECT id, t, {", ".join(f"n{c}" for c in names)}, y{last} FROM (SELECT f.id, f.t + 1 AS t, {", ".join(f"{o}, {s}" for o, s in zip(outs, states))}
    FROM steps f JOIN gains USING (id) JOIN arrays USING (id) WHERE f.t < 1439)),
filtered AS MATERIALIZED (SELECT id, t, y AS v FROM steps WHERE t >= 0)"""


# A transform of 1440 = 36 x 40 points in two sums: bin 40 q + r first over q, then over r.
RECHECK = f"""{_filter_sql()},
mixed AS (SELECT id, p, place // 40 AS q, place % 40 AS r, v FROM filtered JOIN (SELECT p, bin, place FROM perms UNION ALL SELECT -1, bin, bin FROM range(1440) b(bin)) ON bin = t),
rows36 AS (SELECT id, p, r, j, sum(v * cos(2 * pi() * ((j * q) % 36) / 36)) AS re, -sum(v * sin(2 * pi() * ((j * q) % 36) / 36)) AS im
  FROM mixed, range(36) f(j) GROUP BY ALL),
waves AS (SELECT id, p, k, sum(re * cos(2 * pi() * ((k * r) % 1440) / 1440) + im * sin(2 * pi() * ((k * r) % 1440) / 1440)) AS re,
  sum(im * cos(2 * pi() * ((k * r) % 1440) / 1440) - re * sin(2 * pi() * ((k * r) % 1440) / 1440)) AS im
  FROM (SELECT unnest(range(1, 721)) AS k) JOIN rows36 ON j = k % 36 GROUP BY id, p, k),
low_power AS MATERIALIZED (SELECT id, p, k, (CASE WHEN k < 720 THEN 2 ELSE 1 END) / 1440 * (re * re + im * im) AS psd FROM waves),
low_limits AS (SELECT id, top AS threshold FROM (SELECT id, top, row_number() OVER (PARTITION BY id ORDER BY top) AS place FROM
  (SELECT id, p, max(psd) AS top FROM low_power WHERE p >= 0 GROUP BY ALL)) WHERE place = {RANK}),
low_found AS (SELECT id, k, 1440::DOUBLE / k AS period FROM low_power JOIN low_limits USING (id) WHERE p = -1 AND psd > threshold * (1 + 1e-9) AND k > 2),
low_pairs AS (SELECT a.id, b.t - a.t AS lag, sum(a.v * b.v) AS acf FROM filtered a JOIN filtered b ON a.id = b.id AND b.t > a.t GROUP BY ALL),
low_all AS (SELECT * FROM low_pairs UNION ALL SELECT DISTINCT id, 0, 0 FROM filtered),
low_curves AS MATERIALIZED (SELECT id, lag, round(acf / max(acf) OVER (PARTITION BY id), {spectral.ACF_DIGITS}) AS v FROM low_all QUALIFY max(acf) OVER (PARTITION BY id) > 0),
{_peaks_sql("_low", "low_curves", "id")},
low_true AS (SELECT id, arg_min(period, k) AS period FROM low_found f WHERE EXISTS (FROM peaks_low x WHERE x.id = f.id AND x.spot > 1 AND abs(f.period - x.spot) <= {spectral.PERIOD_TOLERANCE}) GROUP BY id)"""


def _detect_sql(cells: str) -> str:
    return f"""WITH RECURSIVE {cells}, {ACTIVE}, {THRESHOLD}, {PSD}, {CURVES.format("pruned")}, {_peaks_sql("_raw", "curves", "day, host")}, {RECHECK},
    kept AS (SELECT day, host, count(*) AS n, min(min_gap) AS min_gap FROM pruned GROUP BY ALL),
    all_found AS (SELECT day, host, count(*) AS n, sum(period) AS total FROM found GROUP BY ALL),
    true_found AS (SELECT day, host, count(*) AS n, sum(period) AS total FROM found f WHERE EXISTS (FROM peaks_raw x WHERE x.day = f.day
      AND x.host = f.host AND abs(f.period - x.spot) <= {spectral.PERIOD_TOLERANCE}) GROUP BY ALL),
    low_kept AS (SELECT day, host, count(*) AS n, sum(t.period) AS total FROM low_true t JOIN pruned USING (id) GROUP BY ALL),
    best AS (SELECT day, host, max(psd) AS top FROM power GROUP BY ALL)
    SELECT day, host, active.ts_cnt::INT AS ts_cnt, round(threshold, 6) AS psd_threshold, round(top / threshold, 6) AS psd_ratio, kept.min_gap::INT AS min_tsinterval,
      all_found.n::INT AS n_potential, kept.n::INT AS n_pruned, coalesce(true_found.n, 0)::INT AS n_true, coalesce(low_kept.n, 0)::INT AS n_lowpass,
      round(all_found.total, 6) AS potential, round(coalesce(true_found.total, 0), 6) AS confirmed, round(coalesce(low_kept.total, 0), 6) AS lowpass
    FROM kept JOIN active USING (day, host) JOIN limits USING (day, host) JOIN all_found USING (day, host) JOIN best USING (day, host)
      LEFT JOIN true_found USING (day, host) LEFT JOIN low_kept USING (day, host)"""


def _told(found):
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 6)
    return found.select(
        *KEYS, "ts_cnt", F.round("psd_threshold", 6).alias("psd_threshold"), F.round("psd_ratio", 6).alias("psd_ratio"),
        "min_tsinterval", F.size("potential_periods").alias("n_potential"), F.size("high_freq_pruned").alias("n_pruned"),
        F.size("true_periods").alias("n_true"), F.size("lowpass_filter_per").alias("n_lowpass"),
        total("potential_periods").alias("potential"), total("true_periods").alias("confirmed"), total("lowpass_filter_per").alias("lowpass"),
    )


@query("periodicity_threshold", f"WITH {NAMED}, {_cells_sql()}, {ACTIVE}, {THRESHOLD} SELECT day, host, round(threshold, 6) AS threshold FROM limits")
def periodicity_threshold(t: Tables):
    """The noise threshold of every series with more than two active bins."""
    found = periodicity.with_threshold(series.build_series(t.web()).where("ts_cnt > 2"))
    return found.select(*KEYS, F.round("psd_threshold", 6).alias("threshold"))


@query("acf_peaks", f"""WITH {NAMED}, {_cells_sql()}, {ACTIVE}, {CURVES.format("active")}, {_peaks_sql("_raw", "curves", "day, host")} SELECT day, host, spot::INT AS lag FROM peaks_raw""")
def acf_peaks(t: Tables):
    """Prominent lags of every series with activity."""
    peaks = periodicity.with_peaks(series.build_series(t.web()).where("ts_cnt > 2"))
    return peaks.select(*KEYS, F.explode("autocorr_peaks").alias("lag"))


@query("periodicity", _detect_sql(f"{NAMED}, {_cells_sql()}"))
def periodicity_query(t: Tables):
    """Whole detection on every host and day."""
    return _told(periodicity.detect_periodicity(series.build_series(t.web())))


BOTH = f"""{HALVES},
cells AS (SELECT day, host, minute, sum(cnt) AS cnt FROM (FROM cells_a UNION ALL FROM cells_b) WHERE minute IS NOT NULL GROUP BY ALL),
series AS (SELECT day, host, a.ts_cnt + b.ts_cnt AS ts_cnt FROM series_a a JOIN series_b b USING (day, host))"""


@query("periodicity_agg", _detect_sql(BOTH))
def periodicity_agg(t: Tables):
    """Detection on the added series of two sites."""
    both = series.merge_sites(*_halves(t)).select(*KEYS, "tdf", F.col("ts_cnt").cast("int").alias("ts_cnt"))
    return _told(periodicity.detect_periodicity(both))


@query(
    "lowpass_recheck",
    f"""WITH RECURSIVE {NAMED}, {_cells_sql()}, {ACTIVE}, {THRESHOLD}, {PSD}, {RECHECK}
    SELECT day, host, round(pruned.period, 6) AS candidate, round(sum(f.v * f.v), 6) AS energy, count(DISTINCT x.spot)::INT AS n_peaks,
      round(any_value(low_true.period), 6) AS survivor
    FROM pruned JOIN filtered f USING (id) LEFT JOIN peaks_low x ON x.id = pruned.id AND x.spot = f.t LEFT JOIN low_true USING (id) GROUP BY day, host, pruned.period""",
)
def lowpass_recheck(t: Tables):
    """Every candidate period with the energy and peaks of the filtered series, and the period that survives there."""
    found = periodicity.detect_periodicity(series.build_series(t.web()))
    told = periodicity.with_recheck(found.select(*KEYS, "tdf", F.explode("high_freq_pruned").alias("candidate")))
    return told.select(*KEYS, F.round("candidate", 6).alias("candidate"), F.round("energy", 6).alias("energy"), "n_peaks", F.round("survivor", 6).alias("survivor"))
