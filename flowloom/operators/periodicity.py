"""Periodicity of daily series.

One series is a fixed number of bins, so the work per row is bounded; rows are spread evenly over the
tasks before the numeric step because it is bound by CPU, not by bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.operators import spectral

CHUNK = 512

DETECTED = (
    ("freq", T.ArrayType(T.DoubleType())),
    ("psd", T.ArrayType(T.DoubleType())),
    ("psd_threshold", T.DoubleType()),
    ("potential_periods", T.ArrayType(T.DoubleType())),
    ("ts_intervals", T.ArrayType(T.IntegerType())),
    ("min_tsinterval", T.IntegerType()),
    ("high_freq_pruned", T.ArrayType(T.DoubleType())),
    ("psd_ratio", T.DoubleType()),
    ("autocorr_peaks", T.ArrayType(T.IntegerType())),
    ("true_periods", T.ArrayType(T.DoubleType())),
    ("lowpass_filter_per", T.ArrayType(T.DoubleType())),
)


def _spread(df: DataFrame, tdf: str) -> DataFrame:
    """Even work over all tasks, by a hash of all columns beside the series and not by a key: a frame that is already
    partitioned by the key would keep its partitions, which may have been coalesced to a few by their bytes.
    """
    session = df.sparkSession
    tasks = max(
        session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions"))
    )
    return df.repartition(tasks, F.xxhash64(*[c for c in df.columns if c != tdf]))


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), CHUNK):
            yield batch.iloc[start : start + CHUNK].reset_index(drop=True)


def _with_fields(schema: T.StructType, fields) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(n, t) for n, t in fields])


def with_spectrum(series: DataFrame, tdf: str = "tdf") -> DataFrame:
    """Add the periodogram ``psd`` (index k is the frequency k/n), its mean and its peak without k = 0."""

    def run(batches):
        for pdf in _chunks(batches):
            if len(pdf):
                power = spectral.periodogram(np.stack(pdf[tdf].to_numpy()).astype(float))
                waves = power[:, 1:]
                yield pdf.assign(psd=list(power), psd_mean=waves.mean(axis=1), psd_max=waves.max(axis=1))

    added = [("psd", T.ArrayType(T.DoubleType())), ("psd_mean", T.DoubleType()), ("psd_max", T.DoubleType())]
    return _spread(series, tdf).mapInPandas(run, _with_fields(series.schema, added))


def with_autocorrelation(series: DataFrame, tdf: str = "tdf") -> DataFrame:
    """Add ``acf``, the autocorrelation by lag with lag 0 set to 0."""

    def run(batches):
        for pdf in _chunks(batches):
            if len(pdf):
                acf = spectral.autocorrelation(np.stack(pdf[tdf].to_numpy()).astype(np.int64))
                yield pdf.assign(acf=list(acf.astype(np.int64)))

    return _spread(series, tdf).mapInPandas(run, _with_fields(series.schema, [("acf", T.ArrayType(T.LongType()))]))


def with_peaks(series: DataFrame, tdf: str = "tdf") -> DataFrame:
    """Add ``autocorr_peaks``, the prominent lags."""

    def run(batches):
        for pdf in _chunks(batches):
            peaks = [spectral.acf_peaks(np.asarray(x, dtype=np.int64)).tolist() for x in pdf[tdf]]
            yield pdf.assign(autocorr_peaks=peaks)

    return _spread(series, tdf).mapInPandas(run, _with_fields(series.schema, [("autocorr_peaks", T.ArrayType(T.IntegerType()))]))


def noise_threshold(
    mean: str | Column = "psd_mean", confidence: float = spectral.CONFIDENCE, ordinates: int = spectral.ORDINATES
) -> Column:
    """Peak power that white noise of the same mean power stays below: the analytic twin of permutation."""
    mean = F.col(mean) if isinstance(mean, str) else mean
    return mean * F.lit(-math.log(1 - confidence ** (1 / ordinates)))


def candidate_periods(
    spectra: DataFrame, keys: Sequence[str], confidence: float = spectral.CONFIDENCE, bins: int = 1440
) -> DataFrame:
    """Frequencies whose power exceeds the analytic threshold, with period below 720."""
    limit = noise_threshold("psd_mean", confidence, bins // 2)
    listed = spectra.where(F.col("psd_max") > limit).select(
        *keys, "psd_mean", F.posexplode("psd").alias("k", "power")
    )
    return listed.where(
        (F.col("k") > 0) & (F.col("power") > limit) & (bins / F.col("k") < spectral.LONGEST_PERIOD)
    ).withColumn("period", F.lit(float(bins)) / F.col("k"))


def with_threshold(series: DataFrame, tdf: str = "tdf") -> DataFrame:
    """Add ``psd_threshold``, the power that the shuffled series stays below with the given confidence."""

    def run(batches):
        for pdf in _chunks(batches):
            found = [spectral.permutation_threshold(np.asarray(x, dtype=float)) for x in pdf[tdf]]
            yield pdf.assign(psd_threshold=found)

    return _spread(series, tdf).mapInPandas(run, _with_fields(series.schema, [("psd_threshold", T.DoubleType())]))


def with_recheck(candidates: DataFrame, period: str = "candidate", tdf: str = "tdf") -> DataFrame:
    """Add what a series low-passed at ``period`` + 1 shows: its energy, its number of prominent lags and the ``survivor``, if any."""

    def run(batches):
        for pdf in _chunks(batches):
            filtered = [spectral.lowpass(np.asarray(x, dtype=float), p + 1) for x, p in zip(pdf[tdf], pdf[period])]
            peaks = [len(spectral.acf_peaks(y)) for y in filtered]
            yield pdf.assign(energy=[float(y @ y) for y in filtered], n_peaks=peaks, survivor=[spectral.surviving_period(y) for y in filtered])

    added = [("energy", T.DoubleType()), ("n_peaks", T.IntegerType()), ("survivor", T.DoubleType())]
    return _spread(candidates, tdf).mapInPandas(run, _with_fields(candidates.schema, added))


def detect_periodicity(series: DataFrame, tdf: str = "tdf", count: str = "ts_cnt") -> DataFrame:
    """Series with more than two active bins, candidate periods and gaps, and what became of them.

    Shuffles are the same for all series and runs, so results depend on nothing but the series.
    """
    active = series.where(F.col(count) > 2)
    schema = _with_fields(series.schema, DETECTED)
    names = schema.names

    def run(batches):
        for pdf in _chunks(batches):
            rows = [{**row, **found} for row in pdf.to_dict("records") if (found := _detect(row[tdf])) is not None]
            yield pd.DataFrame(rows, columns=names)

    return _spread(active, tdf).mapInPandas(run, schema)


def _detect(tdf) -> dict | None:
    x = np.asarray(tdf, dtype=np.int64)
    psd = spectral.periodogram(x.astype(float))
    threshold = spectral.permutation_threshold(x.astype(float))
    potential = spectral.periods_above(psd, threshold, x.size)
    if not potential.size:
        return None
    intervals = np.diff(np.flatnonzero(x > 0))
    if not intervals.size:
        return None
    pruned = potential[potential >= intervals.min()]
    if not pruned.size:
        return None
    peaks = spectral.acf_peaks(x)
    return {
        "freq": spectral.frequencies(x.size).tolist(),
        "psd": psd.tolist(),
        "psd_threshold": threshold,
        "potential_periods": potential.tolist(),
        "ts_intervals": intervals.tolist(),
        "min_tsinterval": int(intervals.min()),
        "high_freq_pruned": pruned.tolist(),
        "psd_ratio": float(psd.max() / threshold),
        "autocorr_peaks": peaks.tolist(),
        "true_periods": spectral.confirmed(potential, peaks).tolist(),
        "lowpass_filter_per": spectral.recheck_filtered(pruned, x),
    }


def t_probability(t: Column, freedom: Column) -> Column:
    """Chance that Student's t with whole ``freedom`` (1 at least) is farther from 0 than ``t``: a finite sum of powers of a cosine."""
    angle = F.atan2(F.abs(t), F.sqrt(freedom.cast("double")))
    odd = freedom % 2
    square = F.pow(F.cos(angle), 2)
    # Term j + 1 is term j times square (2j + 1 + odd) / (2j + 2 + odd); the first is 1, or the cosine if odd.
    first = F.when(odd == 1, F.cos(angle)).otherwise(F.lit(1.0))
    start = F.struct(F.lit(0.0).alias("sum"), first.alias("term"))

    def step(held, j):
        factor = square * (2 * j + 1 + odd) / (2 * j + 2 + odd)
        return F.struct((held["sum"] + held["term"]).alias("sum"), (held["term"] * factor).alias("term"))

    terms = ((freedom - odd) / 2).cast("int")
    total = F.when(terms < 1, F.lit(0.0)).otherwise(F.aggregate(F.sequence(F.lit(0), F.greatest(terms, F.lit(1)) - 1), start, step)["sum"])
    inside = F.when(odd == 1, (angle + F.sin(angle) * total) * F.lit(2 / math.pi)).otherwise(F.sin(angle) * total)
    return F.greatest(F.lit(0.0), 1 - inside)


def period_t(
    profile: DataFrame, period: str = "period", mean: str = "mean_gap", var: str = "var_gap", n: str = "n_gaps",
    sigma: float = 10.0, size: int = 20, alpha: float = 0.05,
) -> DataFrame:
    """Two-sample t of the gaps against ``size`` draws around the period, its two-sided chance, and whether the period is kept.

    The draws enter with their expected mean and variance, so the result is repeatable.
    """
    freedom = F.col(n) + size - 2
    pooled = ((F.col(n) - 1) * F.coalesce(F.col(var), F.lit(0.0)) + (size - 1) * sigma**2) / freedom
    t = (F.col(period) - F.col(mean)) / F.sqrt(pooled * (1 / F.col(n) + F.lit(1.0 / size)))
    tested = profile.withColumn("t_value", t)
    tested = tested.withColumn("p_value", t_probability(F.col("t_value"), freedom))
    return tested.withColumn("kept", F.col("p_value") > alpha)
