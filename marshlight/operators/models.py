"""Per-series models. Spark groups the rows; a group is one monthly series, so it is bounded by the calendar."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

PERIOD = 12
ORDER = PERIOD + 1  # values that the differences, and again the autoregressive terms, take up
MIN_MONTHS = 2 * ORDER + 2
TERM_LIMIT = 0.99
FAINT = 1e-9


def _linear_fill(y: np.ndarray) -> np.ndarray:
    known = np.flatnonzero(~np.isnan(y))
    return np.interp(np.arange(len(y)), known, y[known])


def _weights(phi: np.ndarray, seasonal: np.ndarray) -> np.ndarray:
    """Coefficients of (1 - phi B)(1 - seasonal B^12), a row for each pair of terms."""
    out = np.zeros((len(phi), ORDER + 1))
    out[:, 0], out[:, 1], out[:, PERIOD], out[:, ORDER] = 1.0, -phi, -seasonal, phi * seasonal
    return out


def _start_covariance(weights: np.ndarray) -> np.ndarray:
    """Covariance of the first ORDER values of the stationary process with innovations of variance 1 (Yule-Walker)."""
    lag = np.arange(ORDER + 1)
    system = np.zeros((len(weights), ORDER + 1, ORDER + 1))
    for k in lag:  # sum_j w_j gamma(k - j) = 1 if k = 0 else 0
        for j in lag:
            system[:, k, abs(k - j)] += weights[:, j]
    right = np.zeros((len(weights), ORDER + 1, 1))
    right[:, 0] = 1.0
    gamma = np.linalg.solve(system, right)[:, :, 0]
    return gamma[:, np.abs(lag[:ORDER, None] - lag[None, :ORDER])]


def _differences(n: int) -> np.ndarray:
    """(1 - B)(1 - B^12) as a matrix."""
    out = np.zeros((n - ORDER, n))
    t = np.arange(n - ORDER)
    out[t, t + ORDER], out[t, t + ORDER - 1], out[t, t + 1], out[t, t] = 1.0, -1.0, -1.0, 1.0
    return out


def precision(n: int, phi: np.ndarray, seasonal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Precision of n values of the model with flat priors for its start, and the log determinant of the covariance of
    its differences; innovations have variance 1. A matrix and a number for each pair of terms."""
    weights, d = _weights(phi, seasonal), _differences(n)
    m = n - ORDER
    start = _start_covariance(weights)
    inner = np.zeros((len(phi), m - ORDER, m))
    t = np.arange(m - ORDER)
    for j in range(ORDER + 1):
        inner[:, t, t + ORDER - j] = weights[:, j, None]
    whole = np.swapaxes(inner, 1, 2) @ inner
    whole[:, :ORDER, :ORDER] += np.linalg.inv(start)
    return d.T @ whole @ d, np.linalg.slogdet(start)[1]


def _settle(q: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each precision: the gaps given the rest, the remaining sum of squares, the log determinant of the gaps' precision.

    A very faint pull to the straight line settles gaps that nothing else does (a calendar month that is never known).
    """
    gap = np.isnan(y)
    known, line = y[~gap], _linear_fill(y)[gap]
    inner = q[:, gap][:, :, gap] + FAINT * np.eye(gap.sum())
    across = q[:, gap][:, :, ~gap]
    filled = np.linalg.solve(inner, (FAINT * line - across @ known)[:, :, None])[:, :, 0]
    full = np.broadcast_to(y, (len(q), len(y))).copy()
    full[:, gap] = filled
    return filled, ((q @ full[:, :, None])[:, :, 0] * full).sum(axis=1), np.linalg.slogdet(inner)[1]


def minus_two_log_likelihood(y: np.ndarray, phi: np.ndarray, seasonal: np.ndarray) -> np.ndarray:
    """Of the known values under each pair of terms, innovation variance at its best, gaps integrated out; up to a constant."""
    q, spread = precision(len(y), phi, seasonal)
    _, squares, inner = _settle(q, y)
    free = (~np.isnan(y)).sum() - ORDER
    return free * np.log(np.maximum(squares, 1e-300) / free) + spread + inner


def fitted_terms(y: np.ndarray) -> tuple[float, float]:
    """The two autoregressive terms of largest likelihood: a grid over all stationary ones, then ever finer grids around the best."""
    centre, reach = np.zeros(2), TERM_LIMIT
    for turn in range(16):
        steps = np.linspace(-reach, reach, 5 if turn else 9)
        phi, seasonal = (np.clip(centre[k] + g.ravel(), -TERM_LIMIT, TERM_LIMIT) for k, g in enumerate(np.meshgrid(steps, steps)))
        best = np.argmin(minus_two_log_likelihood(y, phi, seasonal))
        centre, reach = np.array([phi[best], seasonal[best]]), reach / (2 if turn else 3)
    return float(centre[0]), float(centre[1])


def sarima_interpolate(y: np.ndarray) -> np.ndarray:
    """Missing points of a series under ARIMA(1,1,0)(1,1,0)[12] without constant.

    The terms maximise the likelihood of the values that are known, the gaps being integrated out and the start of the series free.
    A gap then takes its mean given all known values, before and after it, as a fixed-interval smoother gives it.
    """
    gaps = np.isnan(y)
    if not gaps.any() or gaps.all():
        return y
    n = len(y)
    if n <= MIN_MONTHS:
        raise ValueError(f"a series with gaps needs more than {MIN_MONTHS} months, this one has {n}")
    if (~gaps).sum() <= ORDER + 2:  # as many free values as the start and the terms take up
        return _linear_fill(y)
    phi, seasonal = (np.array([v]) for v in fitted_terms(y))
    full = y.copy()
    full[gaps] = _settle(precision(n, phi, seasonal)[0], y)[0][0]
    return full


def fill_gaps(df: DataFrame, value: str, estimate: str, unit: str = "ADM2_ID", period: str = "PERIOD",
              threshold: float = 0.0) -> DataFrame:
    """`df` with `estimate`: the value where there is one, a whole modelled number where it is missing.

    Only series with gaps are modelled, on the log scale so estimates cannot be negative; values up to
    `threshold` are no evidence for the model and stay. A series with gaps must be longer than MIN_MONTHS.
    The rows pass through once: the group function returns all columns, so nothing is joined back.
    """
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(period)
        v = pdf[value].to_numpy(dtype=float, na_value=np.nan)
        filled = v
        if np.isnan(v).any() and not np.isnan(v).all():
            with np.errstate(divide="ignore", invalid="ignore"):
                logs = np.where(v > threshold, np.log(v), np.nan)
            modelled = np.round(np.exp(np.minimum(sarima_interpolate(logs), 700)))
            filled = np.where(np.isnan(v), modelled, v)
        return pdf.assign(**{estimate: filled})

    schema = StructType([*df.schema.fields, StructField(estimate, DoubleType())])
    # Fitting takes long for its few rows, so they are dealt to all cores and not gathered by size.
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, unit).groupBy(unit).applyInPandas(one, schema)
