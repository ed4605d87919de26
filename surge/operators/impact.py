"""Impact analytics: exposure days (pollution, heat, cold, humidity) against admissions.

Every statistic is one conditional aggregate (``avg(x) FILTER``-style) over the
un-imputed panel, grouped by key where the result is per key - the reference
re-scans the frame once per statistic.  Missing weather never counts as an
exposure, and a row whose weather is missing is a *normal* day.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surge.functions.columns import flag, pct_change, rowwise_mean
from surge.operators.quantile import quantile_value
from surge.plans.stage import materialize

TOTAL, RESP, ASTHMA = "Total_Hospitalization", "Respiratory_Count", "Asthma_Count"
# Default thresholds (named in degrees C / percent, as in the source data's labels).
HOT, COLD, HUMID = 30.0, 0.0, 80.0
MILD = (10.0, 25.0)
NORMAL_HUMIDITY = (40.0, 70.0)
PM_PATTERN = r"PM25|PM2\.5|(?i:pm25)"


def _avg_if(cond: Column, c: str) -> Column:
    return F.avg(F.when(cond, F.col(c)))


def extreme_condition(df: DataFrame, *, hot: float = HOT, cold: float = COLD, humid: float = HUMID) -> Column:
    """Hot OR cold OR humid, each only if its column exists; missing -> false."""
    parts = []
    if "Temp_Max_C" in df.columns:
        parts.append(flag(F.col("Temp_Max_C") > hot))
    if "Temp_Min_C" in df.columns:
        parts.append(flag(F.col("Temp_Min_C") < cold))
    if "Humidity_Avg" in df.columns:
        parts.append(flag(F.col("Humidity_Avg") > humid))
    out = F.lit(False)
    for p in parts:
        out = out | p
    return out


def extreme_flag(df: DataFrame, *, name: str = "is_extreme", **thresholds) -> DataFrame:
    return df.withColumn(name, extreme_condition(df, **thresholds).cast("int"))


def extreme_totals(df: DataFrame, *, key: str = "borough", measure: str = TOTAL, **thresholds) -> DataFrame:
    """Sum of ``measure`` over extreme-weather rows per key (keys without one are absent)."""
    return df.where(extreme_condition(df, **thresholds)).groupBy(key).agg(F.sum(measure).alias("extreme_total"))


def extreme_uplift_by_key(df: DataFrame, *, key: str = "borough", measure: str = TOTAL, **thresholds) -> DataFrame:
    """Mean on extreme vs normal rows per key and the % change; keys having both kinds only."""
    ex = extreme_condition(df, **thresholds)
    g = df.groupBy(key).agg(_avg_if(ex, measure).alias("extreme_avg"), _avg_if(~ex, measure).alias("normal_avg"),
                            F.count_if(ex).alias("n_extreme_rows"), F.count_if(~ex).alias("n_normal_rows"))
    g = g.where((F.col("n_extreme_rows") > 0) & (F.col("n_normal_rows") > 0))
    return g.withColumn("pct_change", pct_change("extreme_avg", "normal_avg"))


def _exposure_table(df: DataFrame, exposures: dict[str, Column], baseline: Column,
                    measures: Sequence[str]) -> DataFrame:
    """One conditional aggregate, then one row per (exposure, measure)."""
    aggs = [F.count_if(flag(baseline)).alias("n_base")]
    for m in measures:
        aggs.append(_avg_if(flag(baseline), m).alias(f"base__{m}"))
    for e, cond in exposures.items():
        aggs.append(F.count_if(flag(cond)).alias(f"n__{e}"))
        aggs.append(F.countDistinct(F.when(flag(cond), F.col("Date"))).alias(f"d__{e}"))
        for m in measures:
            aggs.append(_avg_if(flag(cond), m).alias(f"{e}__{m}"))
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(e).alias("exposure"), F.lit(m).alias("measure"),
                     F.col(f"{e}__{m}").alias("exposed_avg"), F.col(f"base__{m}").alias("baseline_avg"),
                     F.col(f"n__{e}").alias("n_rows"), F.col(f"d__{e}").alias("n_days"),
                     F.col("n_base").alias("n_baseline_rows"))
            for e in exposures for m in measures]
    t = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return t.where(F.col("n_rows") > 0).withColumn("pct_change", pct_change("exposed_avg", "baseline_avg"))


def temperature_impact(df: DataFrame, *, hot: float = HOT, cold: float = COLD, mild: tuple = MILD,
                       measures: Sequence[str] = (TOTAL, RESP, ASTHMA)) -> DataFrame:
    """Heat (max > hot) and cold (min < cold) against mild days (mild[0] <= max <= mild[1])."""
    base = F.col("Temp_Max_C").between(mild[0], mild[1])
    return _exposure_table(df, {"heat": F.col("Temp_Max_C") > hot, "cold": F.col("Temp_Min_C") < cold},
                           base, [m for m in measures if m in df.columns])


def humidity_impact(df: DataFrame, *, humid: float = HUMID, normal: tuple = NORMAL_HUMIDITY,
                    measures: Sequence[str] = (TOTAL, ASTHMA)) -> DataFrame:
    """High humidity (> humid) against normal (normal[0] <= h <= normal[1])."""
    base = F.col("Humidity_Avg").between(normal[0], normal[1])
    return _exposure_table(df, {"high_humidity": F.col("Humidity_Avg") > humid}, base,
                           [m for m in measures if m in df.columns])


def pm_columns(df: DataFrame, pattern: str = PM_PATTERN) -> list[str]:
    """Columns whose *name* matches the PM2.5 rule."""
    return [c for c in df.columns if re.search(pattern, c)]


def aq_composite_columns(df: DataFrame, prefix: str = "AQ_", exclude: str = "due_to") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix) and exclude not in c]


def high_exposure_days(df: DataFrame, cols: Sequence[str], *, q: float = 0.75, name: str = "exposure") -> DataFrame:
    """Rows with a positive row-mean exposure, flagged ``is_high`` when at or above
    the q-quantile of that exposure (a scalar subquery)."""
    e = materialize(df.withColumn(name, rowwise_mean(cols)).where(F.col(name) > 0))  # read by the selection and by the result
    thr = quantile_value(e, name, q)
    return e.withColumn("is_high", (F.col(name) >= thr).cast("int"))


def high_exposure_totals(df: DataFrame, cols: Sequence[str], *, key: str = "borough", measure: str = TOTAL,
                         q: float = 0.75) -> DataFrame:
    h = high_exposure_days(df, cols, q=q)
    return h.where(F.col("is_high") == 1).groupBy(key).agg(F.sum(measure).alias("high_total"))


def exposure_uplift_by_key(df: DataFrame, cols: Sequence[str], *, key: str = "borough", measure: str = TOTAL,
                           q: float = 0.75) -> DataFrame:
    """Per key: mean on high-exposure vs other positive-exposure rows, % and absolute change."""
    h = high_exposure_days(df, cols, q=q)
    hi = F.col("is_high") == 1
    g = h.groupBy(key).agg(_avg_if(hi, measure).alias("high_avg"), _avg_if(~hi, measure).alias("normal_avg"),
                           F.count_if(hi).alias("n_high_rows"), F.count_if(~hi).alias("n_normal_rows"))
    g = g.where((F.col("n_high_rows") > 0) & (F.col("n_normal_rows") > 0))
    return g.withColumns({"pct_change": pct_change("high_avg", "normal_avg"),
                          "abs_change": F.col("high_avg") - F.col("normal_avg")})


def key_ranking(df: DataFrame, *, key: str = "borough") -> DataFrame:
    """Per key: total, daily mean, asthma and respiratory totals, share of all cases
    and the rank by total (ties: key order).  The share divides by a window over
    the per-key table - one row per key, not per input row."""
    g = df.groupBy(key).agg(F.sum(TOTAL).alias("total_cases"), F.avg(TOTAL).alias("avg_daily_cases"),
                            F.sum(ASTHMA).alias("asthma_cases"), F.sum(RESP).alias("respiratory_cases"),
                            F.count(F.lit(1)).alias("n_rows"))
    w_all = Window.partitionBy()
    return g.withColumns({
        "share_pct": F.try_divide(F.col("total_cases") * 100.0, F.sum("total_cases").over(w_all)),
        "rank": F.row_number().over(Window.orderBy(F.desc("total_cases"), F.asc(key))),
    })


def regional_summary(df: DataFrame, *, key: str = "borough") -> DataFrame:
    """Borough, Total_Cases, Asthma_Cases, Respiratory_Cases, Avg_Daily_Cases."""
    return df.groupBy(F.col(key).alias("Borough")).agg(
        F.sum(TOTAL).alias("Total_Cases"), F.sum(ASTHMA).alias("Asthma_Cases"),
        F.sum(RESP).alias("Respiratory_Cases"), F.avg(TOTAL).alias("Avg_Daily_Cases"))


def regional_headline(df: DataFrame, *, key: str = "borough", date: str = "Date") -> DataFrame:
    """One row: top key per measure (ties -> smaller key), grand total, integer
    mean per key, highest daily mean and the date span."""
    s = regional_summary(df, key=key)  # one row per key; the headline reads only that

    head = s.agg(
        *[F.min_by("Borough", F.struct(F.negative(F.col(c)), F.col("Borough"))).alias(f"top_{n}_key")
          for c, n in (("Total_Cases", "total"), ("Asthma_Cases", "asthma"),
                       ("Respiratory_Cases", "respiratory"), ("Avg_Daily_Cases", "daily_avg"))],
        F.max("Total_Cases").alias("top_total_cases"), F.max("Asthma_Cases").alias("top_asthma_cases"),
        F.max("Respiratory_Cases").alias("top_respiratory_cases"), F.max("Avg_Daily_Cases").alias("top_daily_avg"),
        F.sum("Total_Cases").alias("grand_total"),
        F.floor(F.avg("Total_Cases")).cast("long").alias("mean_per_key"),
    )
    span = df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))
    return head.select("*", span.select("first_date").scalar().alias("first_date"),
                       span.select("last_date").scalar().alias("last_date"))
