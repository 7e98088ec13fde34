"""Cleaning of monthly series: robust seasonal-trend decomposition, a variable-span smoother, outliers, gaps.

Published methods (Cleveland et al. 1990 for the decomposition by local regression, Friedman 1984 for the smoother), on
batches of series of one length: every step is a few array operations for all series at once. A series is as long as the calendar at most.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

PERIOD = 12
# Windows and steps of the decomposition, spans of the smoother, limits of the outlier rule.
SEASON_WINDOW, TREND_WINDOW, LOW_WINDOW = 11, 21, 13
OUTER = 15
SPANS = (0.05, 0.2, 0.5)
STRENGTH, REACH = 0.6, 3.0
HARMONICS = 5
BLOCK = 256  # series cleaned at a time


class Loess:
    """Local regression on 1..n at every `jump`-th point and the last, and on `more` points outside, straight lines in between."""

    def __init__(self, n: int, window_size: int, degree: int, jump: int, more: tuple[int, ...] = ()) -> None:
        at = sorted({*range(1, n + 1, max(1, min(jump, n - 1))), n})
        self.at, self.degree, self.n = np.array([*at, *more], dtype=float), degree, n
        size = min(window_size, n)
        half = (window_size + 1) // 2
        left = np.clip([*(p - half for p in at), *(0 if p < 1 else n for p in more)], 0, n - size).astype(int)
        window = left[:, None] + np.arange(size)
        place = window + 1.0
        reach = np.maximum(self.at - place[:, 0], place[:, -1] - self.at) + max(0, window_size - n) // 2
        gone = np.abs(place - self.at[:, None])
        share = np.divide(gone, reach[:, None], out=np.zeros_like(gone), where=reach[:, None] > 0)
        near = np.where(share <= 0.001, 1.0, (1 - share**3) ** 3) * (share <= 0.999)
        base = np.zeros((len(self.at), n))
        np.put_along_axis(base, window, near, axis=1)
        off = np.arange(1, n + 1) - self.at[:, None]
        self.k, self.inner = len(at), np.array(at)
        # weights, and weights times powers of the distance: sums over a neighbourhood are products with these
        self.moments = np.concatenate([base * off**power for power in range(3 if degree else 1)]).T
        x = np.arange(1, n + 1)
        right = np.clip(np.searchsorted(self.inner, x), 1, max(self.k - 1, 1))
        self.between = np.zeros((self.k, n))
        if self.k < n:
            low, high = self.inner[right - 1], self.inner[right]
            self.between[right - 1, x - 1] += 1 - (x - low) / (high - low)
            self.between[right, x - 1] += (x - low) / (high - low)

    def __call__(self, y: np.ndarray, robust: np.ndarray | None = None) -> np.ndarray:
        """Values at 1..n, then at the points outside; y and the weights have a row for each series."""
        m = len(self.at)
        r = np.ones((1, self.n)) if robust is None else robust
        sums, values = r @ self.moments, (r * y) @ self.moments[:, :2 * m]
        total = sums[:, :m]
        known = np.broadcast_to(total > 0, (len(y), m))
        total = np.where(total > 0, total, 1)
        fitted = values[:, :m] / total
        if self.degree:
            middle = sums[:, m:2 * m] / total
            spread = sums[:, 2 * m:] / total - middle**2
            steep = np.sqrt(np.maximum(spread, 0)) > 0.001 * (self.n - 1)
            slope = np.where(steep, -middle / np.where(steep, spread, 1), 0.0)
            fitted = fitted + slope * (values[:, m:] / total - middle * fitted)
        k = self.k
        fitted[:, :k] = np.where(known[:, :k], fitted[:, :k], y[:, self.inner - 1])
        fitted[:, k:] = np.where(known[:, k:], fitted[:, k:], np.nan)
        if k == self.n:
            return fitted
        return np.concatenate([fitted[:, :k] @ self.between, fitted[:, k:]], axis=1)


@lru_cache(maxsize=512)
def _loess(*shape) -> Loess:
    return Loess(*shape)


def _moving(y: np.ndarray, width: int) -> np.ndarray:
    total = np.cumsum(np.pad(y, ((0, 0), (1, 0))), axis=1)
    return (total[:, width:] - total[:, :-width]) / width


@lru_cache(maxsize=512)
def _without_trend(n: int) -> np.ndarray:
    """The matrix that takes cycles with a year more at both ends to the season: without what a low-pass filter lets through."""
    each = np.eye(n + 2 * PERIOD)
    low = _moving(_moving(_moving(each, PERIOD), PERIOD), 3)
    return each[:, PERIOD:-PERIOD] - _loess(n, LOW_WINDOW, 1, -(-LOW_WINDOW // 10))(low)


def _smooth_months(free: np.ndarray, robust: np.ndarray | None) -> np.ndarray:
    """Each calendar month smoothed over its years, with a year more at both ends; months with as many years go together."""
    rows, n = free.shape
    years, more = divmod(n, PERIOD)
    cycles = np.empty((rows, n + 2 * PERIOD))
    for first, last, k in ((0, more, years + 1), (more, PERIOD, years)):
        if first == last or k == 0:
            continue
        at = np.arange(first, last)[:, None] + PERIOD * np.arange(k)
        own = free[:, at].reshape(-1, k)
        smooth = _loess(k, SEASON_WINDOW, 0, -(-SEASON_WINDOW // 10), (0, k + 1))(own, None if robust is None else robust[:, at].reshape(-1, k))
        before = np.where(np.isnan(smooth[:, k]), smooth[:, 0], smooth[:, k])
        after = np.where(np.isnan(smooth[:, k + 1]), smooth[:, k - 1], smooth[:, k + 1])
        whole = np.concatenate([before[:, None], smooth[:, :k], after[:, None]], axis=1)
        cycles[:, np.arange(first, last)[:, None] + PERIOD * np.arange(k + 2)] = whole.reshape(rows, last - first, k + 2)
    return cycles


def decompose(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seasonal and trend parts of series (rows) without gaps of more than two years, robust to outliers."""
    n = y.shape[1]
    trend, season, robust = np.zeros_like(y), np.zeros_like(y), None
    for turn in range(OUTER + 1):
        season = _smooth_months(y - trend, robust) @ _without_trend(n)
        trend = _loess(n, TREND_WINDOW, 1, -(-TREND_WINDOW // 10))(y - season, robust)
        if turn < OUTER:
            far = np.abs(y - season - trend)
            limit = 6 * np.median(far, axis=1, keepdims=True)
            share = np.divide(far, limit, out=np.full_like(far, 2.0), where=limit > 0)
            robust = np.where((share <= 0.001) | (far == 0), 1.0, np.where(share <= 0.999, (1 - share**2) ** 2, 0.0))
    return season, trend


@lru_cache(maxsize=512)
def _running_lines(n: int, span: float) -> np.ndarray:
    """The matrix that fits a line to the neighbours of each of n points; near the ends the neighbourhood stays whole."""
    half = max(2, int(0.5 * span * n + 0.5))
    size = min(2 * half + 1, n)
    out = np.zeros((n, n))
    for j in range(n):
        start = min(max(j - half, 0), n - size) if size < n else 0
        x = np.arange(start, start + size)
        off = x - x.mean()
        var = (off**2).sum()
        out[j, x] = 1 / size + ((j - x.mean()) * off / var if var > 0 else 0)
    return out


def smooth(y: np.ndarray) -> np.ndarray:
    """Series (rows) smoothed by lines over a span that cross-validation chooses at each point."""
    n = y.shape[1]
    lines = [_running_lines(n, s) for s in SPANS]
    middle = lines[1]
    fits, errors = [], []
    for h in lines:
        fit = y @ h.T
        free = 1 - np.diag(h)
        error = np.divide(np.abs(y - fit), free, out=np.full_like(y, np.nan), where=free > 1e-12)
        for j in np.flatnonzero(free <= 1e-12):  # such a point takes over from the one before
            error[:, j] = error[:, j - 1] if j else 0.0
        fits.append(fit)
        errors.append(error @ middle.T)
    best = np.array(SPANS)[np.argmin(errors, axis=0)]
    span = np.clip(best @ middle.T, SPANS[0], SPANS[-1])
    off = span - SPANS[1]
    up, down = off / (SPANS[2] - SPANS[1]), -off / (SPANS[1] - SPANS[0])
    mixed = np.where(off >= 0, (1 - up) * fits[1] + up * fits[2], (1 - down) * fits[1] + down * fits[0])
    return mixed @ lines[0].T


def straight(y: np.ndarray) -> np.ndarray:
    """Gaps of one series joined by straight lines, ends held level."""
    known = np.flatnonzero(~np.isnan(y))
    return np.interp(np.arange(len(y)), known, y[known]) if len(known) else y


@lru_cache(maxsize=512)
def _seasons_and_time(n: int) -> np.ndarray:
    t = np.arange(1, n + 1)
    waves = [f(2 * np.pi * k * t / PERIOD) for k in range(1, HARMONICS + 1) for f in (np.sin, np.cos)]
    time = np.polynomial.legendre.legvander((2 * t - n - 1) / (n - 1), min(max(n // 10, 1), 6))
    return np.column_stack([time, *waves])


def _first_guess(y: np.ndarray) -> np.ndarray:
    """One series with its gaps from a regression on the seasons and a polynomial of time."""
    design = _seasons_and_time(len(y))
    known = ~np.isnan(y)
    fit = design @ np.linalg.lstsq(design[known], y[known], rcond=None)[0]
    return np.where(known, y, fit)


def interpolate(y: np.ndarray) -> np.ndarray:
    """Series (rows) without gaps: straight lines, and with more than two years of values lines between seasonally adjusted values.

    Estimates more than half a range beyond the values seen make a series fall back to straight lines.
    """
    gaps = np.isnan(y)
    out = y.copy()
    seasonal = gaps.any(axis=1) & ((~gaps).sum(axis=1) > 2 * PERIOD)
    for k in np.flatnonzero(gaps.any(axis=1) & ~seasonal):
        out[k] = straight(y[k])
    rows = np.flatnonzero(seasonal)
    if len(rows):
        season, _ = decompose(np.stack([_first_guess(y[k]) for k in rows]))
        for k, s in zip(rows, season):
            filled = np.where(gaps[k], straight(y[k] - s) + s, y[k])
            low, high = np.nanmin(y[k]), np.nanmax(y[k])
            wild = filled.max() > high + (high - low) / 2 or filled.min() < low - (high - low) / 2
            out[k] = straight(y[k]) if wild else filled
    return out


def _residual(full: np.ndarray) -> np.ndarray:
    """What a smoother leaves of series without gaps; a clear season is taken out before."""
    base = full
    if full.shape[1] > 2 * PERIOD:
        season, trend = decompose(full)
        rest, moving = np.var(full - season - trend, axis=1), np.var(full - trend, axis=1)
        clear = (moving > 0) & (rest <= (1 - STRENGTH) * moving)
        base = np.where(clear[:, None], full - season, full)
    return base - smooth(base)


def _quartiles(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and third quartile of the known values of each row, by straight lines between ranks."""
    ranked = np.sort(y, axis=1)  # missing values come last
    last = (~np.isnan(y)).sum(axis=1) - 1
    rows, out = np.arange(len(y)), []
    for p in (0.25, 0.75):
        at = p * last
        under = np.floor(at).astype(int)
        low, high, share = ranked[rows, under], ranked[rows, np.minimum(under + 1, last)], at - under
        out.append(np.where(share >= 0.5, high - (high - low) * (1 - share), low + (high - low) * share))
    return out[0], out[1]


def _beyond(y: np.ndarray, full: np.ndarray, residual: np.ndarray) -> np.ndarray:
    residual = np.where(np.isnan(y), np.nan, residual)
    q1, q3 = _quartiles(residual)
    low, high = (q1 - REACH * (q3 - q1))[:, None], (q3 + REACH * (q3 - q1))[:, None]
    same = np.ptp(full, axis=1) == 0
    return ((residual < low) | (residual > high)) & (high - low > 1e-14) & ~same[:, None]


def outliers(y: np.ndarray) -> np.ndarray:
    """True for values (rows are series) whose residual is beyond three quartile ranges."""
    full = interpolate(y)
    return _beyond(y, full, _residual(full))


def clean(y: np.ndarray) -> np.ndarray:
    """Series (rows, two values or more each) with outliers replaced and gaps filled; the search is done twice.

    A series without an outlier in the first search is the same in the second, so only the others are decomposed again.
    """
    once = interpolate(y)
    residual = _residual(once)
    first = _beyond(y, once, residual)
    some = first.any(axis=1)
    if some.any():
        once[some] = interpolate(np.where(first, np.nan, y)[some])
        residual[some] = _residual(once[some])
    second = _beyond(once, once, residual)
    redo = second.any(axis=1)
    out = once.copy()
    if redo.any():
        out[redo] = interpolate(np.where(first | second, np.nan, once)[redo])
    return out


def seasonal_distance(y: np.ndarray) -> np.ndarray:
    """How many median absolute deviations each value is from the cleaned series (rows are series of one length).

    Unknown for missing values and for series with fewer than two values or without spread. Series are taken in blocks, so what the
    steps hold at a time does not grow with their number.
    """
    out = np.full(y.shape, np.nan)
    for start in range(0, len(y), BLOCK):
        block = y[start:start + BLOCK]
        rows = np.flatnonzero((~np.isnan(block)).sum(axis=1) >= 2)
        some = block[rows]
        mad = np.nanmedian(np.abs(some - np.nanmedian(some, axis=1, keepdims=True)), axis=1) if len(rows) else np.zeros(0)
        use = mad > 0
        if use.any():
            out[start + rows[use]] = np.abs(some[use] - clean(some[use])) / mad[use, None]
    return out


def seasonal_flags(y: np.ndarray, deviation: float) -> np.ndarray:
    """True where a value is `deviation` median absolute deviations or more from the cleaned series (rows are series of one length)."""
    return seasonal_distance(y) >= deviation  # false where unknown
