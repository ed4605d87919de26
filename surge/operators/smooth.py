"""Curve fits behind the scatter plots: grid LOWESS and a bootstrap band for
the least-squares line.

Both are aggregations: every data partition folds its rows into weighted sums
for each grid point (or replicate) in NumPy (``mapInPandas``), emitting one
small row per grid point / replicate, and Spark adds the partials up.  Rows are
never paired with grid points in the plan, and only the grid or replicate
table (bounded by its parameter, not by the data) is broadcast.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surge.plans.stage import materialize

GRID_SCHEMA = "g int, sw double, swx double, swy double, swxx double, swxy double"


def _grid(df: DataFrame, x: str, points: int) -> np.ndarray:
    lo, hi = df.agg(F.min(x), F.max(x)).first()     # one row
    if lo is None:
        return np.zeros(0)
    return np.linspace(lo, hi, points) if hi > lo else np.array([lo])


def _weighted_sums(df: DataFrame, x: str, y: str, grid: np.ndarray, bw: np.ndarray,
                   fit: np.ndarray | None, scale: float | None) -> pd.DataFrame:
    """Tricube-weighted sums per grid point (times bisquare robustness weights
    from residuals against the previous fit, when ``fit`` is given)."""
    gb = df.sparkSession.sparkContext.broadcast((grid, bw, fit, scale))

    def part(it):
        g, h, f, s = gb.value
        acc = np.zeros((len(g), 5))
        for pdf in it:
            xv = pdf[x].to_numpy(dtype=float)
            yv = pdf[y].to_numpy(dtype=float)
            rob = np.ones_like(xv)
            if f is not None and s:
                r = yv - np.interp(xv, g, f)
                u = np.clip(np.abs(r) / (6.0 * s), 0, 1)
                rob = (1 - u ** 2) ** 2
            d = np.abs(xv[None, :] - g[:, None]) / np.maximum(h[:, None], 1e-12)
            w = np.where(d < 1, (1 - d ** 3) ** 3, 0.0) * rob[None, :]
            acc += np.stack([w.sum(1), (w * xv).sum(1), (w * yv).sum(1), (w * xv * xv).sum(1),
                             (w * xv * yv).sum(1)], axis=1)
        yield pd.DataFrame({"g": np.arange(len(g), dtype=np.int32), "sw": acc[:, 0], "swx": acc[:, 1],
                            "swy": acc[:, 2], "swxx": acc[:, 3], "swxy": acc[:, 4]})

    sums = df.select(x, y).mapInPandas(part, GRID_SCHEMA).groupBy("g").sum().toPandas()   # G rows
    return sums.sort_values("g")


def lowess_grid(df: DataFrame, *, x: str, y: str, frac: float = 2.0 / 3.0, iterations: int = 3,
                points: int = 50) -> DataFrame:
    """LOWESS fit of y on x evaluated at ``points`` evenly spaced grid points.

    Bandwidth at a grid point: the distance to its ceil(frac * n)-th nearest x
    (from ``percentile_approx`` of |x - g|, one aggregate for all points).
    Robustness passes reweight rows by the bisquare of their residual against
    the previous fit interpolated at x (scale: 6 x median |residual|)."""
    data = materialize(df.select(F.col(x).cast("double").alias(x), F.col(y).cast("double").alias(y)).dropna())  # read by every pass
    grid = _grid(data, x, points)
    spark = df.sparkSession
    if len(grid) == 0:
        return spark.createDataFrame([], "x double, fit double")
    bw_row = data.agg(*[F.percentile_approx(F.abs(F.col(x) - float(g)), frac, 100000).alias(f"h{i}")
                        for i, g in enumerate(grid)]).first()
    bw = np.array([bw_row[f"h{i}"] for i in range(len(grid))], dtype=float)
    fit, scale = None, None
    for it in range(iterations + 1):
        s = _weighted_sums(data, x, y, grid, bw, fit, scale)
        sw = s["sum(sw)"].to_numpy()
        xm = s["sum(swx)"].to_numpy() / np.where(sw > 0, sw, 1)
        ym = s["sum(swy)"].to_numpy() / np.where(sw > 0, sw, 1)
        sxx = s["sum(swxx)"].to_numpy() - sw * xm * xm
        sxy = s["sum(swxy)"].to_numpy() - sw * xm * ym
        slope = np.where(sxx > 1e-12 * np.maximum(sw, 1e-300), sxy / np.where(sxx != 0, sxx, 1), 0.0)
        fit = ym + slope * (grid - xm)
        if it == iterations:
            break
        g_b = spark.sparkContext.broadcast((grid, fit))

        def resid(it_):
            g, f = g_b.value
            for pdf in it_:
                yield pd.DataFrame({"r": np.abs(pdf[y].to_numpy(float) - np.interp(pdf[x].to_numpy(float), g, f))})
        scale = data.mapInPandas(resid, "r double").agg(F.percentile_approx("r", 0.5, 100000)).first()[0]
    return spark.createDataFrame(pd.DataFrame({"x": grid.astype(float), "fit": fit.astype(float)}))


def _splitmix(v: np.ndarray) -> np.ndarray:
    z = (v + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _poisson1(u: np.ndarray) -> np.ndarray:
    """Poisson(1) draws by inverse CDF of uniforms."""
    cdf = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(cdf, u, side="right").astype(float)


def bootstrap_band(df: DataFrame, *, x: str, y: str, id_col: str, replicates: int = 1000, points: int = 50,
                   ci: float = 95.0, seed: int = 42) -> DataFrame:
    """Confidence band of the least-squares line by the Poisson bootstrap: each
    row gets a Poisson(1) weight per replicate from a hash of (row id, replicate,
    seed) - deterministic under recomputation - partitions fold weighted sums
    per replicate, and the band is the percentile of the replicate lines at each
    grid point."""
    data = materialize(df.select(F.xxhash64(id_col).alias("_id"), F.col(x).cast("double").alias(x),
                                 F.col(y).cast("double").alias(y)).dropna())  # read for the range and for the sums
    spark = df.sparkSession
    R = replicates

    def part(it):
        acc = np.zeros((R, 5))
        reps = np.arange(R, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for pdf in it:
                ids = pdf["_id"].to_numpy().astype(np.int64).view(np.uint64)
                h = _splitmix(ids[:, None] * np.uint64(1_000_003) + reps[None, :] + np.uint64(seed))
                w = _poisson1((h >> np.uint64(11)).astype(np.float64) / float(1 << 53))
                xv = pdf[x].to_numpy(float)[:, None]
                yv = pdf[y].to_numpy(float)[:, None]
                acc += np.stack([w.sum(0), (w * xv).sum(0), (w * yv).sum(0), (w * xv * xv).sum(0),
                                 (w * xv * yv).sum(0)], axis=1)
        yield pd.DataFrame({"r": np.arange(R, dtype=np.int32), "sw": acc[:, 0], "swx": acc[:, 1],
                            "swy": acc[:, 2], "swxx": acc[:, 3], "swxy": acc[:, 4]})

    s = data.mapInPandas(part, "r int, sw double, swx double, swy double, swxx double, swxy double") \
            .groupBy("r").agg(*[F.sum(c).alias(c) for c in ("sw", "swx", "swy", "swxx", "swxy")])
    xm, ym = F.col("swx") / F.col("sw"), F.col("swy") / F.col("sw")
    slope = F.try_divide(F.col("swxy") - F.col("sw") * xm * ym, F.col("swxx") - F.col("sw") * xm * xm)
    lines = s.select("r", slope.alias("b"), (ym - slope * xm).alias("a"))
    grid = _grid(data, x, points)
    lo, hi = (100 - ci) / 200, 1 - (100 - ci) / 200
    # each replicate line evaluated at the G grid points: R x G rows, bounded by the parameters
    pts = lines.select("a", "b", F.explode(F.array(*[F.lit(float(g)) for g in grid])).alias("x")) \
               .select("x", (F.col("a") + F.col("b") * F.col("x")).alias("v"))
    return pts.groupBy("x").agg(F.percentile("v", F.lit(lo)).alias("lower"), F.percentile("v", F.lit(hi)).alias("upper"))
