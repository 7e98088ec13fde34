"""Window and model code against plain brute force on small series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marshlight.operators import cleaning, models
from marshlight.operators.models import sarima_interpolate
from marshlight.operators.quantiles import exact_quantiles
from marshlight.operators.series import with_seasonal_flag


def fill_line(y):
    known = np.flatnonzero(~np.isnan(y))
    return np.interp(np.arange(len(y)), known, y[known])


def local(y, xs, left, right, window, degree, robust):
    """One local regression at xs over the points left..right (from 1)."""
    reach = max(xs - left, right - xs) + max(0, window - len(y)) // 2
    points = []
    for j in range(left, right + 1):
        gone = abs(j - xs)
        if gone <= 0.999 * reach:
            points.append((j, (1.0 if gone <= 0.001 * reach else (1 - (gone / reach) ** 3) ** 3) * robust[j - 1], y[j - 1]))
    total = sum(w for _, w, _ in points)
    if total <= 0:
        return None
    middle = sum(w * j for j, w, _ in points) / total
    value = sum(w * v for _, w, v in points) / total
    spread = sum(w * (j - middle) ** 2 for j, w, _ in points) / total
    if degree and spread ** 0.5 > 0.001 * (len(y) - 1):
        value += (xs - middle) / spread * sum(w * (j - middle) * v for j, w, v in points) / total
    return value


def regress(y, window, degree, jump, robust):
    n = len(y)
    jump, half = max(1, min(jump, n - 1)), (window + 1) // 2
    at = sorted({*range(1, n + 1, jump), n})
    fits = []
    for p in at:
        left = 1 if window >= n or p < half else min(p - half + 1, n - window + 1)
        fit = local(y, p, left, min(n, left + window - 1), window, degree, robust)
        fits.append(y[p - 1] if fit is None else fit)
    return np.interp(np.arange(1, n + 1), at, fits)


def mean_of(y, width):
    return np.array([np.mean(y[i:i + width]) for i in range(len(y) - width + 1)])


def brute_seasons(y):
    n = len(y)
    trend, robust = np.zeros(n), np.ones(n)
    for turn in range(16):
        cycles = np.zeros(n + 24)
        for month in range(12):
            own, w = (y - trend)[month::12], robust[month::12]
            k = len(own)
            inside = regress(own, 11, 0, 2, w)
            first, last = local(own, 0, 1, min(11, k), 11, 0, w), local(own, k + 1, max(1, k - 10), k, 11, 0, w)
            cycles[month::12] = [inside[0] if first is None else first, *inside, inside[-1] if last is None else last]
        low = regress(mean_of(mean_of(mean_of(cycles, 12), 12), 3), 13, 1, 2, np.ones(n))
        season = cycles[12:-12] - low
        trend = regress(y - season, 21, 1, 3, robust)
        far = np.abs(y - season - trend)
        six = 6 * np.median(far)
        robust = np.array([1.0 if f <= 0.001 * six else (1 - (f / six) ** 2) ** 2 if f <= 0.999 * six else 0.0 for f in far])
    return season, trend


def lines(y, span):
    n = len(y)
    half = max(2, int(0.5 * span * n + 0.5))
    size = min(2 * half + 1, n)
    fit, error = [], []
    for j in range(n):
        start = min(max(j - half, 0), n - size)
        x = np.arange(start, start + size)
        slope, level = np.polyfit(x, y[x], 1) if size > 1 else (0.0, y[0])
        fit.append(level + slope * j)
        free = 1 - 1 / size - ((j - x.mean()) ** 2 / ((x - x.mean()) ** 2).sum() if size > 1 else 0)
        error.append(abs(y[j] - fit[-1]) / free if free > 1e-12 else error[-1] if j else 0.0)
    return np.array(fit), np.array(error)


def brute_smooth(y):
    fits, errors = zip(*[(f, lines(e, 0.2)[0]) for f, e in (lines(y, s) for s in (0.05, 0.2, 0.5))])
    best = [(0.05, 0.2, 0.5)[int(np.argmin(e))] for e in zip(*errors)]
    out = []
    for j, span in enumerate(np.clip(lines(np.array(best), 0.2)[0], 0.05, 0.5)):
        side = (2, (span - 0.2) / 0.3) if span >= 0.2 else (0, (0.2 - span) / 0.15)
        out.append((1 - side[1]) * fits[1][j] + side[1] * fits[side[0]][j])
    return lines(np.array(out), 0.05)[0]


def brute_fill(y):
    gap = np.isnan(y)
    if not gap.any() or (~gap).sum() <= 24:
        return fill_line(y)
    n = len(y)
    t = np.arange(1, n + 1)
    x = np.column_stack([((t - n / 2) / n) ** d for d in range(min(max(n // 10, 1), 6) + 1)]
                        + [f(2 * np.pi * k * t / 12) for k in range(1, 6) for f in (np.sin, np.cos)])
    guess = np.where(gap, x @ np.linalg.lstsq(x[~gap], y[~gap], rcond=None)[0], y)
    season, _ = brute_seasons(guess)
    out = np.where(gap, fill_line(y - season) + season, y)
    low, high = np.nanmin(y), np.nanmax(y)
    return fill_line(y) if out.max() > high + (high - low) / 2 or out.min() < low - (high - low) / 2 else out


def brute_outliers(y):
    full = brute_fill(y)
    if np.ptp(full) == 0:
        return np.zeros(len(y), dtype=bool)
    base = full
    if len(y) > 24:
        season, trend = brute_seasons(full)
        if 1 - np.var(full - season - trend) / np.var(full - trend) >= 0.6:
            base = full - season
    r = np.where(np.isnan(y), np.nan, base - brute_smooth(base))
    q1, q3 = np.nanquantile(r, [0.25, 0.75])
    return ((r < q1 - 3 * (q3 - q1)) | (r > q3 + 3 * (q3 - q1))) & (q3 - q1 > 1e-14)


def brute_clean(y):
    first = brute_outliers(y)
    once = brute_fill(np.where(first, np.nan, y))
    second = brute_outliers(once)
    return brute_fill(np.where(first | second, np.nan, once)) if second.any() else once


def brute_flag(values, deviation):
    known = values[~np.isnan(values)]
    if len(known) < 2:
        return [False] * len(values)
    mad = np.median(np.abs(known - np.median(known)))
    if mad == 0:
        return [False] * len(values)
    gap = np.abs(values - brute_clean(values)) / mad
    return [bool(g >= deviation) for g in gap]


@pytest.mark.parametrize("n", [25, 30, 48, 61])
def test_decomposition_and_cleaning_match_plain_loops(n):
    rng = np.random.default_rng(n)
    t = np.arange(n)
    y = np.stack([100 + t + 40 * np.sin(t / 6 * np.pi) + rng.normal(0, s, n) for s in (1, 5, 60)])
    y[:, n // 2] += 400
    season, trend = cleaning.decompose(y)
    for k in range(len(y)):
        want = brute_seasons(y[k])
        assert np.allclose(season[k], want[0], atol=1e-8) and np.allclose(trend[k], want[1], atol=1e-8)
        assert np.allclose(cleaning.smooth(y)[k], brute_smooth(y[k]), atol=1e-8)
    y[rng.random(y.shape) < 0.1] = np.nan
    assert np.allclose(cleaning.clean(y), [brute_clean(v) for v in y], atol=1e-6)


def test_planted_outliers_are_flagged_and_seasonal_peaks_are_not(spark):
    rng = np.random.default_rng(1)
    t = np.arange(60)
    rows = []
    for unit in range(20):
        y = np.round(200 + 150 * np.sin(t / 6 * np.pi) + rng.normal(0, 5, 60))
        y[30 + unit] += 900
        rows += [(unit, "I", int(k), float(v)) for k, v in enumerate(y)]
    flagged = with_seasonal_flag(spark.createDataFrame(rows, "OU_ID int, INDICATOR string, PERIOD int, VALUE double"), 3, "f").where("f").collect()
    assert {(r.OU_ID, r.PERIOD) for r in flagged} == {(unit, 30 + unit) for unit in range(20)}


@pytest.mark.parametrize("length", [1, 2, 3, 7, 24, 25, 60])
def test_seasonal_flag_matches_brute_force(spark, length):
    rng = np.random.default_rng(length)
    rows, want = [], {}
    for unit in range(6):
        y = np.round(50 + 30 * np.sin(np.arange(length) / 12 * 2 * np.pi) + rng.normal(0, 3, length))
        y[rng.random(length) < 0.15] = np.nan
        if length > 5:
            y[length // 2] = 400.0
        if unit == 5:
            y[:] = 4.0
        if np.isnan(y).all():
            y[0] = 1.0
        want[unit] = brute_flag(y, 3)
        rows += [(unit, "I", i, None if np.isnan(v) else float(v)) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "OU_ID int, INDICATOR string, PERIOD int, VALUE double")
    got = {}
    for r in with_seasonal_flag(df, 3, "f").orderBy("OU_ID", "PERIOD").collect():
        got.setdefault(r.OU_ID, []).append(r.f)
    assert got == want


def kalman(y, phi, seasonal, prior=1e7):
    """-2 log likelihood (variance at its best, up to a constant) and smoothed values by a Kalman filter and smoother.

    State: 13 values of the differenced process, then the last 13 values of the series with a wide prior.
    """
    w = np.zeros(13)
    w[0], w[11], w[12] = phi, seasonal, -phi * seasonal
    move = np.zeros((26, 26))
    move[0, :13], move[1:13, :12] = w, np.eye(12)
    move[13, :13] = w
    move[13, [13, 24, 25]] = 1, 1, -1
    move[14:, 13:25] = np.eye(12)
    shock = np.zeros((26, 1))
    shock[[0, 13]] = 1
    stationary = np.zeros((13, 13))
    start = np.zeros((13, 13))
    start[0, 0] = 1.0
    step, part = move[:13, :13].copy(), start
    for _ in range(40):  # sum of powers by doubling
        part = part + step @ part @ step.T
        step = step @ step
    stationary = part
    mean, cov = np.zeros(26), np.zeros((26, 26))
    cov[:13, :13], cov[13:, 13:] = stationary, prior * np.eye(13)
    means, covs, ahead, aheads, logs, squares, seen = [], [], [], [], 0.0, 0.0, 0
    for v in y:
        mean, cov = move @ mean, move @ cov @ move.T + shock @ shock.T
        ahead.append(mean), aheads.append(cov)
        if not np.isnan(v):
            f, gain = cov[13, 13], cov[:, 13] / cov[13, 13]
            e = v - mean[13]
            if f < prior / 1e3:
                logs, squares, seen = logs + np.log(f), squares + e * e / f, seen + 1
            else:
                logs += np.log(f / prior)
            mean, cov = mean + gain * e, cov - np.outer(gain, cov[13])
        means.append(mean), covs.append(cov)
    smooth = [means[-1]]
    for k in range(len(y) - 2, -1, -1):
        back = covs[k] @ move.T @ np.linalg.pinv(aheads[k + 1], rcond=1e-13)
        smooth.insert(0, means[k] + back @ (smooth[0] - ahead[k + 1]))
    return seen * np.log(squares / seen) + logs, np.array([m[13] for m in smooth])


def gappy_series(seed, n=66):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    y = 4 + 0.3 * np.sin(t / 6 * np.pi) + np.cumsum(rng.normal(0, 0.1, n))
    y[rng.choice(np.arange(14, n), 7, replace=False)] = np.nan
    return y


@pytest.mark.parametrize("seed", [1, 2])
def test_likelihood_and_gaps_are_those_of_a_kalman_filter_and_smoother(seed):
    y = gappy_series(seed)
    pairs = np.array([[0.3, -0.5], [-0.4, 0.2], [0.0, 0.0], [0.6, 0.7]])
    ours = models.minus_two_log_likelihood(y, pairs[:, 0], pairs[:, 1])
    theirs = np.array([kalman(y, *p)[0] for p in pairs])
    assert np.allclose(ours - ours[0], theirs - theirs[0], atol=1e-3)
    terms = models.fitted_terms(y)
    for near in ((0.02, 0), (-0.02, 0), (0, 0.02), (0, -0.02)):
        assert kalman(y, terms[0] + near[0], terms[1] + near[1])[0] > kalman(y, *terms)[0] - 1e-4
    assert np.allclose(sarima_interpolate(y), kalman(y, *terms)[1], atol=1e-4)


def test_gaps_are_the_generalised_least_squares_solution():
    """Dense: the gaps as unknown coefficients of a regression of the differences with the covariance of the model."""
    y = gappy_series(5)
    phi, seasonal = models.fitted_terms(y)
    n, gap = len(y), np.isnan(y)
    m = n - 13
    psi = np.zeros(4000)
    psi[0] = 1.0
    for k in range(1, 4000):  # moving-average weights of the process, so covariances by plain sums
        psi[k] = phi * psi[k - 1] + (seasonal * psi[k - 12] if k >= 12 else 0) - (phi * seasonal * psi[k - 13] if k >= 13 else 0)
    gamma = np.array([psi[:4000 - h] @ psi[h:] for h in range(m)])
    root = np.linalg.inv(np.linalg.cholesky(gamma[np.abs(np.subtract.outer(np.arange(m), np.arange(m)))]))
    d = np.array([[{0: 1, 1: -1, 12: -1, 13: 1}.get(t + 13 - c, 0) for c in range(n)] for t in range(m)], dtype=float)
    solved = np.linalg.lstsq(root @ d[:, gap], -root @ d[:, ~gap] @ y[~gap], rcond=None)[0]
    assert np.allclose(sarima_interpolate(y)[gap], solved, atol=1e-6)


def test_gap_fill_recovers_a_seasonal_series():
    t = np.arange(72)
    y = 3 + 0.01 * t + np.sin(t / 12 * 2 * np.pi)
    holes = y.copy()
    holes[[20, 21, 40, 55]] = np.nan
    assert np.abs(sarima_interpolate(holes) - y).max() < 0.05


def test_gap_fill_needs_two_years_and_more():
    assert list(sarima_interpolate(np.array([1.0, 2.0, 3.0]))) == [1.0, 2.0, 3.0]
    with pytest.raises(ValueError, match="more than 28 months"):
        sarima_interpolate(np.array([1.0, np.nan, 3.0]))


@pytest.mark.parametrize("probs", [[0.0, 0.5, 1.0], [0.1, 0.25, 0.999]])
def test_exact_quantiles(spark, probs):
    rng = np.random.default_rng(3)
    rows = [("hot", float(v)) for v in rng.lognormal(3, 3, 4000)] + [("same", 7.0)] * 50 + [("one", -2.5)]
    rows += [("neg", float(v)) for v in -np.round(rng.exponential(5, 300))] + [("hot", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {(r.k, r.prob): r.quantile for r in exact_quantiles(df, "v", probs, ["k"]).collect()}
    for k in ("hot", "same", "one", "neg"):
        data = [v for key, v in rows if key == k and v is not None]
        for p in probs:
            assert got[k, p] == pytest.approx(np.quantile(data, p), rel=1e-12)


def test_exact_quantiles_with_one_far_outlier(spark):
    rng = np.random.default_rng(4)
    data = [*rng.normal(100, 1, 20_000).tolist(), 1e300, -1e300]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    got = {r.prob: r.quantile for r in exact_quantiles(df, "v", [0.25, 0.5, 0.999]).collect()}
    assert got == {p: pytest.approx(np.quantile(data, p), rel=1e-12) for p in got}


def test_exact_quantiles_whole_table(spark):
    df = spark.range(1001).select((F.col("id") % 37).alias("v"))
    got = {r.prob: r.quantile for r in exact_quantiles(df, "v", [0.5, 0.9]).collect()}
    data = [i % 37 for i in range(1001)]
    assert got == {p: pytest.approx(np.quantile(data, p)) for p in (0.5, 0.9)}
