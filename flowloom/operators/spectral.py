"""Array maths on one series at a time: periodogram, autocorrelation, peaks, low-pass filter.

Small numpy helpers; Spark hands them batches of rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np

PERMUTATIONS = 60
CONFIDENCE = 0.95
LONGEST_PERIOD = 720
ORDINATES = 720
PROMINENCE = 0.2
PERIOD_TOLERANCE = 2
FILTER_ORDER = 10
FILTER_RATE = 1440
TIE = 1e-9
#: Digits of the scaled autocorrelation of a filtered series: neighbours that are equal but for rounding are a plateau.
ACF_DIGITS = 9


def frequencies(n: int) -> np.ndarray:
    return np.arange(n // 2 + 1) / n


def periodogram(x: np.ndarray) -> np.ndarray:
    """One-sided power density along the last axis, mean removed, sample rate 1."""
    n = x.shape[-1]
    power = np.abs(np.fft.rfft(x - x.mean(axis=-1, keepdims=True))) ** 2 / n
    inner = slice(1, -1) if n % 2 == 0 else slice(1, None)
    power[..., inner] *= 2
    return power


@lru_cache(maxsize=8)
def permutations(n: int, count: int) -> np.ndarray:
    """``count`` orders of ``n`` bins: the p-th sorts bins by md5 of ``p:bin``, so every engine can draw the same ones."""
    digests = [[hashlib.md5(f"{p}:{i}".encode()).digest() for i in range(n)] for p in range(count)]
    return np.array([sorted(range(n), key=own.__getitem__) for own in digests], dtype=np.int64).reshape(count, n)


def permutation_threshold(x: np.ndarray, count: int = PERMUTATIONS, confidence: float = CONFIDENCE) -> float:
    """Peak power that a shuffled series stays below with the given confidence.

    All series are shuffled by the same orders: the shares among one series' shuffles are what counts.
    """
    highest = np.sort(periodogram(x[permutations(x.size, count)]).max(axis=1))
    return float(highest[int(confidence * count) - 1])


def periods_above(psd: np.ndarray, threshold: float, n: int) -> np.ndarray:
    """Periods below 720 bins whose power exceeds the threshold, lowest frequency first.

    Equal powers of a shuffled and the given series do occur; TIE keeps rounding from deciding on them.
    """
    picked = np.flatnonzero(psd > threshold * (1 + TIE))
    picked = picked[picked > 0]
    periods = 1 / frequencies(n)[picked]
    return periods[periods < LONGEST_PERIOD]


def autocorrelation(x: np.ndarray) -> np.ndarray:
    """Correlation with itself for lags 0 .. n-1 along the last axis, lag 0 set to 0."""
    n = x.shape[-1]
    spectrum = np.fft.rfft(x, 2 * n)
    result = np.fft.irfft(np.abs(spectrum) ** 2, 2 * n)[..., :n]
    if np.issubdtype(x.dtype, np.integer):
        result = np.rint(result)
    result[..., 0] = 0
    return result


def local_maxima(y: np.ndarray) -> np.ndarray:
    """Inner positions higher than both neighbours; a plateau counts at its middle."""
    starts = np.flatnonzero(np.r_[True, y[1:] != y[:-1]])
    ends = np.r_[starts[1:] - 1, y.size - 1]
    level = y[starts]
    inner = np.zeros(starts.size, dtype=bool)
    if starts.size > 2:
        inner[1:-1] = (level[1:-1] > level[:-2]) & (level[1:-1] > level[2:])
    return (starts[inner] + ends[inner]) // 2


def prominence(y: np.ndarray, peak: int) -> float:
    """Height over the higher of the two lowest points before the curve rises above the peak."""
    higher = np.flatnonzero(y > y[peak])
    at = np.searchsorted(higher, peak)
    left = higher[at - 1] + 1 if at > 0 else 0
    right = higher[at] if at < higher.size else y.size
    return float(y[peak] - max(y[left : peak + 1].min(), y[peak:right].min()))


def acf_peaks(x: np.ndarray, least: float = PROMINENCE) -> np.ndarray:
    """Lags where the autocorrelation, scaled to a maximum of 1, peaks with enough prominence."""
    acf = autocorrelation(x)
    top = acf.max()
    if not top > 0:
        return np.zeros(0, dtype=int)
    y = acf / top
    if not np.issubdtype(x.dtype, np.integer):
        y = np.round(y, ACF_DIGITS)
    found = local_maxima(y)
    found = found[y[found] - y.min() >= least]
    return np.array([p for p in found if prominence(y, p) >= least], dtype=int)


def confirmed(periods: np.ndarray, peaks: np.ndarray, tolerance: float = PERIOD_TOLERANCE) -> np.ndarray:
    """Periods within ``tolerance`` bins of an autocorrelation peak."""
    if not len(periods) or not len(peaks):
        return np.zeros(0)
    near = np.abs(np.asarray(periods)[:, None] - np.asarray(peaks)[None, :]).min(axis=1)
    return np.asarray(periods)[near <= tolerance]


def lowpass_sections(cutoff: float, order: int = FILTER_ORDER, rate: float = FILTER_RATE) -> np.ndarray:
    """Butterworth low-pass as second-order sections (b0 b1 b2 a1 a2), one per pole pair."""
    warped = np.tan(np.pi * cutoff / rate)
    k = np.arange(order // 2)
    damping = 2 * np.sin(np.pi * (2 * k + 1) / (2 * order))
    scale = 1 + damping * warped + warped**2
    b0 = warped**2 / scale
    a1 = 2 * (warped**2 - 1) / scale
    a2 = (1 - damping * warped + warped**2) / scale
    return np.stack([b0, 2 * b0, b0, a1, a2], axis=1)


@lru_cache(maxsize=2048)
def lowpass_response(cutoff: float, n: int) -> np.ndarray:
    """First ``n`` samples of the filter's answer to a unit impulse; there are at most n/2 cutoffs."""
    signal = np.zeros(n)
    signal[0] = 1.0
    for b0, b1, b2, a1, a2 in lowpass_sections(cutoff).tolist():
        out = [0.0] * n
        z1 = z2 = 0.0
        for i, value in enumerate(signal.tolist()):
            y = b0 * value + z1
            z1 = b1 * value - a1 * y + z2
            z2 = b2 * value - a2 * y
            out[i] = y
        signal = np.array(out)
    return signal


def lowpass(x: np.ndarray, cutoff: float) -> np.ndarray:
    """Causal filtering; exact on the first n samples because later impulse samples cannot reach them."""
    n = x.size
    response = lowpass_response(float(cutoff), n)
    return np.fft.irfft(np.fft.rfft(x, 2 * n) * np.fft.rfft(response, 2 * n), 2 * n)[:n]


def surviving_period(filtered: np.ndarray) -> float | None:
    """The first period of a filtered series above its own threshold that its own autocorrelation confirms."""
    candidates = periods_above(periodogram(filtered), permutation_threshold(filtered), filtered.size)
    peaks = acf_peaks(filtered)
    survivors = confirmed(candidates, peaks[peaks > 1])
    return float(survivors[0]) if survivors.size else None


def recheck_filtered(periods: np.ndarray, x: np.ndarray) -> list[float]:
    """For each candidate the first period that survives on the series low-passed at period + 1."""
    found = (surviving_period(lowpass(x.astype(float), period + 1)) for period in periods)
    return [period for period in found if period is not None]
