"""Time-series operators: daily spine, calendar resampling, winsorising,
classical additive decomposition, linear fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surge.operators.impute import interpolate_limited
from surge.operators.ordered import rolling_mean_rows
from surge.operators.quantile import quantile_table


def daily_spine(df: DataFrame, *, key: str = "borough", date: str = "Date", value: str,
                gap: str = "zero") -> DataFrame:
    """Daily resample-sum per key from its first to its last day.

    ``gap="zero"``: a day without rows (or with only missing values) sums to 0,
    as a pandas resample-sum does; ``gap="null"`` leaves it missing.  The spine
    comes from one (min, max) row per key; its size is the number of calendar
    days, not the number of input rows.
    """
    daily = df.groupBy(key, date).agg(
        (F.coalesce(F.sum(value), F.lit(0.0)) if gap == "zero" else F.sum(value)).alias(value))
    bounds = daily.groupBy(key).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    spine = bounds.select(key, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias(date))
    out = spine.join(daily, on=[key, date], how="left")
    if gap == "zero":
        out = out.withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))
    return out


def min_length_series(df: DataFrame, *, key: str = "borough", value: str, min_days: int = 14) -> DataFrame:
    """Keep keys having at least ``min_days`` non-missing values (count per key, then semi join)."""
    ok = df.groupBy(key).agg(F.count(value).alias("_n")).where(F.col("_n") >= min_days).select(key)
    return df.join(ok, on=[key], how="left_semi")


def winsorize(df: DataFrame, *, value: str, key: str | None = "borough", method: str = "iqr",
              p_low: float = 0.01, p_high: float = 0.99, iqr_mult: float = 1.5) -> DataFrame:
    """Clip ``value`` per key to [q1 - m*IQR, q3 + m*IQR] (``iqr``) or to the
    [p_low, p_high] quantiles (``percentile``).  Quantiles are exact and interpolate
    linearly; a key without values keeps its rows as they are.  The bounds are one row per key."""
    if method == "iqr":
        qs = [0.25, 0.75]
    elif method == "percentile":
        qs = [p_low, p_high]
    else:
        raise ValueError(f"Unknown method for outlier handling: {method}")
    keys = [key] if key else []
    b = quantile_table(df, [value], qs, keys=keys).select(*keys, F.col("q0").alias("_qa"), F.col("q1").alias("_qb"))
    if method == "iqr":
        iqr = F.col("_qb") - F.col("_qa")
        b = b.select(*keys, (F.col("_qa") - iqr_mult * iqr).alias("_lo"), (F.col("_qb") + iqr_mult * iqr).alias("_hi"))
    else:
        b = b.select(*keys, F.col("_qa").alias("_lo"), F.col("_qb").alias("_hi"))
    if keys:
        j, lo, hi = df.join(b, on=keys, how="left"), F.col("_lo"), F.col("_hi")
    else:  # one-row bounds as scalar subqueries
        j, lo, hi = df, b.select("_lo").scalar(), b.select("_hi").scalar()
    v = F.col(value)
    out = j.withColumn(value, F.when(v.isNull() | lo.isNull(), v).otherwise(F.least(F.greatest(v, lo), hi)))
    return out.drop("_lo", "_hi") if keys else out


def winsor_log_series(df: DataFrame, *, key: str = "borough", date: str = "Date", value: str,
                      method: str = "iqr", gap: str = "zero") -> DataFrame:
    """Series preparation: daily spine -> gap interpolation (limit 3) -> missing as 0
    -> winsorise -> clip at 0 -> log1p -> interpolation of what is left."""
    s = daily_spine(df, key=key, date=date, value=value, gap=gap)
    if gap != "zero":  # with zero-filled gaps every value is present: interpolation is a no-op
        s = interpolate_limited(s, [value], key=key, date=date, limit=3)
    s = s.withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))
    s = winsorize(s, value=value, key=key, method=method)
    # every value is present from here on, so the closing interpolation has nothing to fill
    return s.withColumn(value, F.log1p(F.greatest(F.col(value), F.lit(0.0))))


def additive_decompose(df: DataFrame, *, key: str = "borough", date: str = "Date", value: str,
                       period: int = 7) -> DataFrame:
    """Classical additive decomposition (odd period): centred moving-average trend
    (missing where the window is incomplete), phase means of the detrended
    series centred to zero, residual.  Rows must be one per (key, day), in
    order; phases count from each key's first row.

    The trend is a fan-out over row numbers folded by one grouped aggregate
    (each row feeds the ``period`` rows it is a neighbour of); phase means are
    a (key, phase) aggregate - nothing holds a whole key in one task.
    """
    half = period // 2
    t = rolling_mean_rows(df.select(key, date, value), [value], window=period, shift=-half, keys=[key],
                          order=[date], name="_m", count_name="_c")
    n = t.groupBy(key).agg(F.max("_rn").alias("_n"))   # one row per key
    t = t.join(n, on=[key])
    trend = F.when((F.col("_c") == period) & (F.col("_rn") > half) & (F.col("_rn") <= F.col("_n") - half),
                   F.col("_m"))
    t = t.select(key, date, "_rn", F.col(value).alias("observed"), trend.alias("trend"),
                 ((F.col("_rn") - 1) % period).alias("_phase"))
    ph = t.groupBy(key, "_phase").agg(F.avg(F.col("observed") - F.col("trend")).alias("_pm"))
    ph_mean = ph.groupBy(key).agg(F.avg("_pm").alias("_pmm"))
    ph = ph.join(ph_mean, on=[key]).select(key, "_phase", (F.col("_pm") - F.col("_pmm")).alias("seasonal"))
    out = t.join(ph, on=[key, "_phase"], how="left")
    return out.select(key, date, "observed", "trend", "seasonal",
                      (F.col("observed") - F.col("trend") - F.col("seasonal")).alias("resid"))


def weather_linear_fit(df: DataFrame, *, targets: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """Least-squares line of each target on each variable over complete pairs:
    (target, variable, slope, intercept, r2, n).  One unpivot + one algebraic
    aggregate; a constant variable gives NULL slope."""
    targets, variables = list(targets), list(variables)
    pairs = [F.struct(F.lit(t).alias("target"), F.lit(v).alias("variable"),
                      F.col(t).cast("double").alias("y"), F.col(v).cast("double").alias("x"))
             for t in targets for v in variables]
    long = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    return long.groupBy("target", "variable").agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.regr_r2("y", "x").alias("r2"),
        F.regr_count("y", "x").alias("n"))


def month_spine(df: DataFrame, *, date: str = "Date") -> DataFrame:
    """One row per calendar month between the first and the last date (``_m``)."""
    b = df.agg(F.trunc(F.min(date), "MM").alias("_lo"), F.trunc(F.max(date), "MM").alias("_hi"))
    return b.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 MONTH"))).alias("_m"))


def monthly_means(df: DataFrame, measures: Sequence[str], *, date: str = "Date") -> DataFrame:
    """Frame-level monthly means labelled by month end; empty months are kept (all NULL)."""
    g = df.groupBy(F.trunc(F.col(date), "MM").alias("_m")).agg(*[F.avg(c).alias(c) for c in measures])
    out = month_spine(df, date=date).join(g, on=["_m"], how="left")
    return out.select(F.last_day("_m").alias(date), *measures)


def three_month_means(df: DataFrame, measures: Sequence[str], *, date: str = "Date") -> DataFrame:
    """Means over 3-month bins anchored on the first month end: bin 0 is the first
    month alone, then three months each; labelled by the bin's last month end.
    Empty bins are kept."""
    first = df.agg(F.trunc(F.min(date), "MM").alias("_first"))
    i = F.months_between(F.trunc(F.col(date), "MM"), F.col("_first")).cast("int")
    first_s = first.select("_first").scalar()
    tagged = df.withColumn("_first", first_s).withColumn("_bin", F.ceil(i / 3).cast("int"))
    g = tagged.groupBy("_bin").agg(*[F.avg(c).alias(c) for c in measures])
    ms = month_spine(df, date=date).withColumn("_first", first_s) \
        .select(F.ceil(F.months_between("_m", "_first").cast("int") / 3).cast("int").alias("_bin")).distinct()
    out = ms.join(g, on=["_bin"], how="left")
    return out.select(F.last_day(F.add_months(first_s, F.col("_bin") * 3)).alias(date), *measures)


def monthly_by_key(df: DataFrame, *, key: str = "borough", date: str = "Date", sums: Sequence[str] = (),
                   means: Sequence[str] = ()) -> DataFrame:
    """Key x month: sums of case columns, means of weather columns (no empty months)."""
    return df.groupBy(key, F.last_day(F.col(date)).alias(date)).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.avg(c).alias(c) for c in means])
