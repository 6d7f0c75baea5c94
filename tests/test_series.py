import math
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowloom.operators import periodicity, series, spectral


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=4, max_size=40))
def test_periodogram_is_the_transform(xs):
    x = np.array(xs, float)
    n = x.size
    centred = x - x.mean()
    for k, got in enumerate(spectral.periodogram(x)):
        w = sum(v * complex(math.cos(2 * math.pi * k * i / n), -math.sin(2 * math.pi * k * i / n)) for i, v in enumerate(centred))
        scale = 1 if k == 0 or 2 * k == n else 2
        assert got == pytest.approx(scale * abs(w) ** 2 / n, abs=1e-9)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=3, max_size=60))
def test_autocorrelation_is_the_sum_of_products(xs):
    x = np.array(xs)
    want = np.correlate(x, x, "full")[x.size - 1 :]
    want[0] = 0
    assert spectral.autocorrelation(x).tolist() == want.tolist()


def plain_peaks(y, least):
    """Peaks and prominences by walking."""
    found, i = [], 1
    while i < len(y) - 1:
        j = i
        while j < len(y) - 1 and y[j + 1] == y[i]:
            j += 1
        if y[i - 1] < y[i] and j < len(y) - 1 and y[j + 1] < y[i]:
            p = (i + j) // 2
            lows = []
            for step in (-1, 1):
                low, k = y[p], p
                while 0 <= k < len(y) and y[k] <= y[p]:
                    low, k = min(low, y[k]), k + step
                lows.append(low)
            if y[p] - max(lows) >= least:
                found.append(p)
        i = j + 1
    return found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=3, max_size=40))
def test_peaks_and_prominence(ys):
    y = np.array(ys, float)
    got = [p for p in spectral.local_maxima(y) if spectral.prominence(y, p) >= 2]
    assert got == plain_peaks(ys, 2)


def test_filter_is_a_butterworth_lowpass():
    for cutoff in (3, 11, 61, 481):
        h = spectral.lowpass_sections(cutoff)
        for f, want in ((0, 1.0), (cutoff, math.sqrt(0.5))):
            z = np.exp(-2j * np.pi * f / 1440)
            gain = np.prod([(b0 + b1 * z + b2 * z**2) / (1 + a1 * z + a2 * z**2) for b0, b1, b2, a1, a2 in h])
            assert abs(gain) == pytest.approx(want, rel=1e-6)
        f = cutoff * 1.3
        warp = math.tan(math.pi * f / 1440) / math.tan(math.pi * cutoff / 1440)
        z = np.exp(-2j * np.pi * f / 1440)
        gain = np.prod([(b0 + b1 * z + b2 * z**2) / (1 + a1 * z + a2 * z**2) for b0, b1, b2, a1, a2 in h])
        assert abs(gain) == pytest.approx(1 / math.sqrt(1 + warp**20), rel=1e-4)


def test_filtering_equals_the_recursion():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 3, 200).astype(float)
    want = x.copy()
    for b0, b1, b2, a1, a2 in spectral.lowpass_sections(40):
        out = np.zeros_like(want)
        for i in range(want.size):
            at = lambda s, j: s[j] if j >= 0 else 0.0
            out[i] = b0 * want[i] + b1 * at(want, i - 1) + b2 * at(want, i - 2) - a1 * at(out, i - 1) - a2 * at(out, i - 2)
        want = out
    assert spectral.lowpass(x, 40) == pytest.approx(want, abs=1e-9)


def test_beacon_noise_and_quiet_series(spark):
    beacon, lone = [0] * 1440, [0] * 1440
    for i in range(3, 1440, 10):
        beacon[i] = 1
    for i in (5, 600):
        lone[i] = 1
    noise = np.random.default_rng(4).integers(0, 2, 1440).tolist()
    df = spark.createDataFrame(
        [("beacon", beacon, 144), ("noise", noise, sum(noise)), ("lone", lone, 2), ("empty", [0] * 1440, 0)],
        "host string, tdf array<int>, ts_cnt int",
    )
    got = {r.host: r for r in periodicity.detect_periodicity(df).collect()}
    assert 10.0 in [round(p, 6) for p in got["beacon"].true_periods]
    assert got["beacon"].min_tsinterval == 10 and got["beacon"].psd_ratio > 1
    assert set(got) <= {"beacon", "noise"}
    again = {r.host: r for r in periodicity.detect_periodicity(df.repartition(7)).collect()}
    assert again == got


def test_series_bins(spark):
    logs = [
        ("u1", "1.1.1.1", "h", datetime(2024, 1, 15, 5, 0, 30)),    # local midnight
        ("u1", "1.1.1.1", "h", datetime(2024, 1, 15, 9, 0, 0)),     # same connection, later log
        ("u2", "1.1.1.1", "h", datetime(2024, 1, 15, 5, 0, 59)),
        ("u3", "1.1.1.1", "h", datetime(2024, 1, 15, 23, 59, 0)),
        ("u4", "1.1.1.1", "early", datetime(2024, 1, 15, 4, 59, 59)),  # the local day before
        ("u5", "9.9.9.9", "", datetime(2024, 1, 15, 6, 0, 0)),
    ]
    df = spark.createDataFrame(logs, "uid string, id_resp_h string, host string, ts timestamp_ntz").withColumn(
        "ts", F.col("ts").cast("timestamp")
    ).withColumn("day", F.lit("2024-01-15").cast("date"))
    got = {r.host: r for r in series.build_series(df).collect()}
    assert {h: r.ts_cnt for h, r in got.items()} == {"h": 2, "early": 0, "missing_9.9.9.9": 1}
    assert all(len(r.tdf) == 1440 for r in got.values())
    assert got["h"].tdf[0] == 2 and got["h"].tdf[18 * 60 + 59] == 1 and sum(got["h"].tdf) == 3
    assert sum(got["early"].tdf) == 0


def test_noise_threshold_is_near_the_permuted_one(spark):
    x = np.zeros(1440)
    x[np.random.default_rng(2).choice(1440, 200, replace=False)] = 1
    mean = spectral.periodogram(x)[1:].mean()
    analytic = spark.createDataFrame([(float(mean),)], "psd_mean double").select(periodicity.noise_threshold()).first()[0]
    permuted = spectral.permutation_threshold(x)
    assert analytic == pytest.approx(permuted, rel=0.25)


def test_shuffles_are_those_of_md5():
    import hashlib

    orders = spectral.permutations(30, 4)
    assert [sorted(o) for o in orders.tolist()] == [list(range(30))] * 4 and len({tuple(o) for o in orders.tolist()}) == 4
    assert orders[2].tolist() == sorted(range(30), key=lambda i: hashlib.md5(f"2:{i}".encode()).hexdigest())


def test_chance_of_t(spark):
    """Known two-sided points of Student's distribution, and its symmetry."""
    known = [(1, 12.706205, 0.05), (2, 4.302653, 0.05), (5, 2.570582, 0.05), (10, 3.169273, 0.01), (19, 2.093024, 0.05), (60, 2.000298, 0.05), (1000, 2.580755, 0.01), (7, 0.0, 1.0)]
    df = spark.createDataFrame([(v, t, p) for v, t, p in known] + [(v, -t, p) for v, t, p in known], "v int, t double, p double")
    for r in df.withColumn("got", periodicity.t_probability(F.col("t"), F.col("v"))).collect():
        assert r.got == pytest.approx(r.p, abs=2e-6)
