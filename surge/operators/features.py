"""Feature engineering, target, splits and scaling for the model stage."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surge.functions.columns import season
from surge.operators.clean import numeric_columns
from surge.operators.ordered import lag_rows, rolling_mean_rows
from surge.operators.quantile import quantile_value

# Columns the lag step shifts, and columns never used as features.
LAG_COLUMNS = ("Total_Hospitalization", "Respiratory_Count", "Asthma_Count",
               "Temp_Max_C", "Humidity_Avg", "WindSpeed_mps")
EXCLUDE_FEATURES = (
    "Date", "Total_Hospitalization", "Respiratory_Count", "Asthma_Count", "High_Risk", "month_period",
    "AQ_Asthma_emergency_department_visits_due_to_PM25",
    "AQ_Asthma_emergency_departments_visits_due_to_Ozone",
    "AQ_Asthma_hospitalizations_due_to_Ozone",
    "AQ_Cardiac_and_respiratory_deaths_due_to_Ozone",
    "AQ_Cardiovascular_hospitalizations_due_to_PM25_age_40+",
    "AQ_Deaths_due_to_PM25",
    "AQ_Respiratory_hospitalizations_due_to_PM25_age_20+",
    "Total_Hospitalization_lag1", "Asthma_Count_lag1", "Respiratory_Count_lag1",
    "Temp_Max_C_lag1", "Humidity_Avg_lag1", "WindSpeed_mps_lag1",
)


def calendar_features(df: DataFrame, *, date: str = "Date") -> DataFrame:
    """year, month, day, day_of_week (Monday = 0), quarter, is_weekend, season."""
    d = F.col(date)
    return df.withColumns({
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": F.weekday(d),
        "quarter": F.quarter(d),
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
        "season": season(F.month(d)),
    })


def one_hot_key(df: DataFrame, *, key: str = "borough", values: Iterable[str], prefix: str | None = None) -> DataFrame:
    """One 0/1 column per known key value (``<prefix>_<value>``); the key column stays."""
    prefix = key if prefix is None else prefix
    return df.withColumns({f"{prefix}_{v}": (F.col(key) == F.lit(v)).cast("int") for v in values})


def range_features(df: DataFrame) -> DataFrame:
    out = {}
    if {"Temp_Max_C", "Temp_Min_C"} <= set(df.columns):
        out["Temp_Range"] = F.col("Temp_Max_C") - F.col("Temp_Min_C")
    if {"Humidity_Max", "Humidity_Min"} <= set(df.columns):
        out["Humidity_Range"] = F.col("Humidity_Max") - F.col("Humidity_Min")
    return df.withColumns(out) if out else df


def lag_features_series(df: DataFrame, cols: Sequence[str], *, lags: Sequence[int] = (1, 2, 3),
                        key: str = "borough", date: str = "Date", same_day: bool = True) -> DataFrame:
    """Per-key row lags (``<c>_lag<k>``) plus same-day alias columns (``<c>_same_day``)."""
    cols = [c for c in cols if c in df.columns]
    out = lag_rows(df, cols, lags, keys=[key], order=[date])
    if same_day:
        out = out.withColumns({f"{c}_same_day": F.col(c) for c in cols})
    return out


def lag_features_frame(df: DataFrame, cols: Sequence[str] = LAG_COLUMNS, *, lags: Sequence[int] = (1, 7),
                       key: str = "borough", date: str = "Date") -> DataFrame:
    """Row lags over the whole frame sorted by (date, key): with interleaved keys,
    lag 1 is usually another key's same day (the main path's rule)."""
    cols = [c for c in cols if c in df.columns]
    return lag_rows(df, cols, lags, keys=[], order=[date, key])


def rolling_mean_shift(df: DataFrame, cols: Sequence[str], *, window: int = 7, shift: int = 3,
                       key: str = "borough", date: str = "Date") -> DataFrame:
    """Per key: mean of the ``window`` rows ending ``shift`` rows back (min 1 value)."""
    return rolling_mean_rows(df, [c for c in cols if c in df.columns], window=window, shift=shift,
                             keys=[key], order=[date]).drop("_rn")


def high_risk_target(df: DataFrame, *, col: str = "Total_Hospitalization", q: float = 0.75,
                     inclusive: bool = True, name: str = "High_Risk",
                     fit_on: DataFrame | None = None) -> DataFrame:
    """Binary target: value >= (or >) the q-quantile of ``col``.  By default the
    threshold uses all rows; pass ``fit_on`` (e.g. train rows) to restrict it."""
    thr = quantile_value(fit_on if fit_on is not None else df, col, q)
    cond = (F.col(col) >= thr) if inclusive else (F.col(col) > thr)
    return df.withColumn(name, cond.cast("int"))


def temporal_split(df: DataFrame, *, train_years: Iterable[int], val_years: Iterable[int],
                   test_years: Iterable[int], date: str = "Date", name: str = "split") -> DataFrame:
    """Split label by year; rows of other years get NULL (not used)."""
    y = F.year(F.col(date))
    return df.withColumn(name, F.when(y.isin(*list(train_years)), "train")
                                .when(y.isin(*list(val_years)), "val")
                                .when(y.isin(*list(test_years)), "test"))


def stratified_split(df: DataFrame, *, label: str, id_cols: Sequence[str], test: float = 0.15,
                     val: float = 0.176, seed: int = 42, name: str = "split") -> DataFrame:
    """Deterministic stratified split (test share, then val share of the rest) per class, with exact counts.

    Rows are ordered inside each class by a seeded hash of their id; the hashes at the class's two cuts are found by distributed
    selection, and a row's side follows from comparing its hash with them: no row is shuffled for it.  Of rows that
    repeat an id all fall on one side.  A label has few classes; rows without one get NULL."""
    from surge.operators.quantile import rank_values
    h = F.xxhash64(*[F.col(c) for c in id_cols], F.lit(seed))
    n_test = F.round(F.col("n") * test)
    cuts = {"test": n_test, "val": n_test + F.round((F.col("n") - n_test) * val)}
    found = rank_values(df.select(F.col(label), h.alias("_h")), label, "_h", cuts)
    said = found.groupBy(label).agg(F.max(F.when(F.col("p") == "test", F.col("value"))).alias("test"),
                                    F.max(F.when(F.col("p") == "val", F.col("value"))).alias("val"))
    by_class = said.agg(F.map_from_entries(F.collect_list(F.struct(F.col(label), F.struct("test", "val")))).alias("m")).select("m").scalar()
    cut = F.element_at(by_class, F.col(label))
    return df.withColumn(name, F.when(F.col(label).isNull(), F.lit(None)).when(h <= cut.getField("test"), "test")
                                .when(h <= cut.getField("val"), "val").otherwise("train"))


def feature_columns(df: DataFrame, *, exclude: Iterable[str] = EXCLUDE_FEATURES) -> list[str]:
    """Numeric columns minus the excluded list, anything with 'year' and 'Unnamed*'."""
    ex = set(exclude)
    return [c for c in numeric_columns(df) if c not in ex and "year" not in c.lower()
            and not c.startswith("Unnamed") and c != "split"]


def feature_matrix(df: DataFrame, *, features: Sequence[str] | None = None,
                   target: str = "Total_Hospitalization", keep: Sequence[str] = ("Date", "borough")) -> DataFrame:
    """Rows with a target; chosen feature columns with missing -> 0."""
    features = list(features) if features is not None else feature_columns(df)
    extra = [c for c in ("High_Risk", "split") if c in df.columns and c not in keep]
    return df.where(F.col(target).isNotNull()).select(
        *keep, target, *extra, *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c) for c in features])


def feature_manifest(spark: SparkSession, features: Sequence[str]) -> DataFrame:
    """(Feature_Name, Feature_Index) in model-input order."""
    return spark.createDataFrame([(f, i) for i, f in enumerate(features)], "Feature_Name string, Feature_Index int")


def standardize(df: DataFrame, cols: Sequence[str], *, fit_on: DataFrame | None = None,
                suffix: str = "") -> DataFrame:
    """(x - mean) / population std using statistics of ``fit_on`` (train rows);
    a constant column is divided by 1.  Statistics are one-row scalar subqueries."""
    src = fit_on if fit_on is not None else df
    stats = src.agg(F.struct(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                             *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)])).scalar()
    out = {}
    for i, c in enumerate(cols):
        m, s = stats.getField(f"m_{i}"), stats.getField(f"s_{i}")
        out[c + suffix] = (F.col(c) - m) / F.when((s.isNull()) | (s == 0), F.lit(1.0)).otherwise(s)
    return df.withColumns(out)
