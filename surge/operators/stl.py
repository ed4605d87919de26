"""Robust STL decomposition per key (Cleveland, Cleveland, McRae & Terpenning 1990).

STL is sequential within one series, so each key's daily series is one group
of ``applyInPandas``; the group is one row per calendar day of that key (its
size is bounded by the calendar span, not by the volume of the raw feeds),
and the keys run in parallel.  The numerical core is a short NumPy
implementation of the paper's inner / outer loops with local-linear loess.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def _loess(y: np.ndarray, q: int, weights: np.ndarray | None, positions: np.ndarray) -> np.ndarray:
    """Local-linear loess of y (at 0..n-1) evaluated at integer ``positions``
    with the q nearest points and tricube weights (times robustness
    ``weights``).  On an even grid the q nearest points of a position form a
    contiguous window, so all positions are fitted at once."""
    n = len(y)
    w_rob = np.ones(n) if weights is None else weights
    qe = min(q, n)
    pos = np.asarray(positions, dtype=float)
    start = np.clip(np.round(pos).astype(int) - (qe - 1) // 2, 0, n - qe)
    idx = start[:, None] + np.arange(qe)[None, :]
    x = idx.astype(float)
    d = np.abs(x - pos[:, None])
    h = d.max(axis=1)
    if q > n:
        h = h + (q - n) / 2.0
    h = np.maximum(h, 1e-12)
    u = np.clip(d / h[:, None], 0.0, 1.0)
    w = (1 - u ** 3) ** 3 * w_rob[idx]
    sw = w.sum(axis=1)
    safe = np.where(sw > 0, sw, 1.0)
    xm = (w * x).sum(axis=1) / safe
    yv = y[idx]
    ym = (w * yv).sum(axis=1) / safe
    sxx = (w * (x - xm[:, None]) ** 2).sum(axis=1)
    sxy = (w * (x - xm[:, None]) * (yv - ym[:, None])).sum(axis=1)
    slope = np.where(sxx > 1e-12 * np.maximum(sw, 1e-300), sxy / np.where(sxx > 0, sxx, 1.0), 0.0)
    out = ym + slope * (pos - xm)
    return np.where(sw > 0, out, np.nan)


def _moving_average(y: np.ndarray, w: int) -> np.ndarray:
    c = np.cumsum(np.insert(y, 0, 0.0))
    return (c[w:] - c[:-w]) / w


def stl_numpy(y: np.ndarray, period: int = 7, seasonal: int = 7, trend: int | None = None,
              low_pass: int | None = None, robust: bool = True, inner: int | None = None,
              outer: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trend, seasonal, resid) of an evenly spaced series without gaps."""
    n = len(y)
    if trend is None:
        trend = int(math.ceil(1.5 * period / (1 - 1.5 / seasonal)))
        trend += (trend % 2 == 0)
    if low_pass is None:  # smallest odd number above the period
        low_pass = period + 1
        low_pass += (low_pass % 2 == 0)
    inner = (2 if robust else 5) if inner is None else inner
    outer = (15 if robust else 0) if outer is None else outer
    t = np.zeros(n)
    s = np.zeros(n)
    rho = np.ones(n)
    for it in range(outer + 1):
        for _ in range(inner):
            detr = y - t
            c = np.empty(n + 2 * period)
            for ph in range(period):
                sub = detr[ph::period]
                wsub = rho[ph::period]
                m = len(sub)
                sm = _loess(sub, seasonal, wsub, np.arange(-1, m + 1, dtype=float))
                c[ph::period][: m + 2] = sm
            lp = _moving_average(_moving_average(_moving_average(c, period), period), 3)
            lp = _loess(lp, low_pass, None, np.arange(n, dtype=float))
            s = c[period:period + n] - lp
            t = _loess(y - s, trend, rho, np.arange(n, dtype=float))
        if not robust or it == outer:
            break
        r = np.abs(y - t - s)
        h = 6 * np.median(r)
        u = np.clip(r / h, 0, 1) if h > 0 else np.zeros(n)
        rho = (1 - u ** 2) ** 2
    return t, s, y - t - s


def stl_decompose(df: DataFrame, *, key: str = "borough", date: str = "Date", value: str, period: int = 7,
                  robust: bool = True, min_days: int = 14) -> DataFrame:
    """Per key: observed, trend, seasonal, resid of a gap-free daily series
    (build it with ``daily_spine``).  Keys with fewer than ``min_days`` values
    are skipped, as is a series STL cannot fit."""
    schema = f"{key} string, {date} date, observed double, trend double, seasonal double, resid double"

    def per_key(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date)
        y = pdf[value].to_numpy(dtype=float)
        if np.isfinite(y).sum() < min_days or len(y) < 2 * period + 1:
            return pd.DataFrame(columns=[key, date, "observed", "trend", "seasonal", "resid"])
        tr, se, re = stl_numpy(y, period=period, robust=robust)
        return pd.DataFrame({key: pdf[key].to_numpy(), date: pdf[date].to_numpy(), "observed": y,
                             "trend": tr, "seasonal": se, "resid": re})

    return df.select(key, date, value).groupBy(key).applyInPandas(per_key, schema)
