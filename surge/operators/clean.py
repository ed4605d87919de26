"""Cleaning and per-day aggregation of the three feeds (weather, visits, air quality).

Every operator is DataFrame -> DataFrame with keyword parameters, usable with
``df.transform``.  The day x key aggregates shuffle once on (date, key); the
later joins on the same keys reuse that partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surge.functions.columns import (
    canonical_key, coerce_numeric, nan_to_null, parse_date, sanitize_name,
)

# Weather element codes and the names the panel uses for them.
WEATHER_CODES = {
    "TMAX": "Temp_Max_C",
    "TMIN": "Temp_Min_C",
    "PRCP": "Precip_mm",
    "AWND": "WindSpeed_mps",
    "RHAV": "Humidity_Avg",
    "RHMX": "Humidity_Max",
    "RHMN": "Humidity_Min",
    "SNWD": "Snow_Depth",
    "SNOW": "Snowfall",
    "WDF2": "FastWind2m_deg",
    "WDF5": "FastWind5s_deg",
    "ADPT": "DewPoint_Temp",
    "ASLP": "AirPres",
    "ASTP": "AirPres_Station",
    "AWBT": "AirTemp_WetBulb",
    "AWDR": "Avg_Wind_Dir",
}

DEFAULT_KEYS = ("brooklyn", "bronx", "manhattan", "staten island", "queens")
DEFAULT_YEARS = (2017, 2018, 2019, 2023, 2024)
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in ex]


def select_present(df: DataFrame, cols: Sequence[str], *, strict: bool = False) -> DataFrame:
    """Column pruning: lenient keeps those present; strict raises on a missing one."""
    missing = [c for c in cols if c not in df.columns]
    if strict and missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[c for c in cols if c in df.columns])


def filter_years(df: DataFrame, *, years: Iterable[int] = DEFAULT_YEARS, date: str = "Date") -> DataFrame:
    """Keep rows whose date falls in one of ``years``, written as date ranges so a
    raw date column prunes parquet row groups."""
    cond = None
    for y in sorted(set(years)):
        c = (F.col(date) >= F.lit(f"{y}-01-01").cast("date")) & (F.col(date) < F.lit(f"{y + 1}-01-01").cast("date"))
        cond = c if cond is None else cond | c
    return df.where(cond if cond is not None else F.lit(False))


def filter_valid_keys(df: DataFrame, *, keys: Iterable[str] = DEFAULT_KEYS, key: str = "borough") -> DataFrame:
    """Keep the listed (canonical) keys; a literal IN list is pushed to both sides of joins."""
    return df.where(F.col(key).isin(*list(keys)))


def weather_clean(df: DataFrame, *, date: str = "DATE", key: str = "borough",
                  rename: dict[str, str] | None = None) -> DataFrame:
    """One row per (Date, key) with the mean of each weather element.

    Codes are renamed to panel names, only known columns are kept (lenient),
    the key is trimmed and lower-cased, NaN counts as missing and rows without
    date or key are dropped before grouping.
    """
    rename = WEATHER_CODES if rename is None else rename
    d = parse_date(date) if dict(df.dtypes).get(date) == "string" else F.col(date).cast("date")
    present = [k for k in rename if k in df.columns]
    return (df.select(d.alias("Date"), canonical_key(key).alias("borough"),
                      *[nan_to_null(k).alias(rename[k]) for k in present])
              .where(F.col("Date").isNotNull() & F.col("borough").isNotNull())
              .groupBy("Date", "borough")
              .agg(*[F.avg(rename[k]).alias(rename[k]) for k in present]))


def visits_daily_sum(df: DataFrame, *, date: str = "Date", key: str = "Dim1Value",
                     count: str = "Count", name: str = "Count",
                     years: Iterable[int] | None = None) -> DataFrame:
    """Sum of leniently parsed counts per (Date, borough); an all-unparsable group sums to 0."""
    d = parse_date(date) if dict(df.dtypes).get(date) == "string" else F.col(date).cast("date")
    out = df.select(d.alias("Date"), canonical_key(key).alias("borough"), coerce_numeric(count).alias("_c")) \
            .where(F.col("Date").isNotNull() & F.col("borough").isNotNull())
    if years is not None:
        out = filter_years(out, years=years)
    return out.groupBy("Date", "borough").agg(F.coalesce(F.sum("_c"), F.lit(0.0)).alias(name))


def _daily_counts(df: DataFrame, *, date: str, key: str, count: str) -> DataFrame:
    d = parse_date(date) if dict(df.dtypes).get(date) == "string" else F.col(date).cast("date")
    return df.select(d.alias("Date"), canonical_key(key).alias("borough"), coerce_numeric(count).alias("_c")) \
             .where(F.col("Date").isNotNull() & F.col("borough").isNotNull())


def health_daily(respiratory: DataFrame, asthma: DataFrame, *,
                 years: Iterable[int] | None = DEFAULT_YEARS, date: str = "Date", key: str = "Dim1Value",
                 count: str = "Count") -> DataFrame:
    """Respiratory and asthma sums per (Date, key) with a missing side as 0,
    their total and the year, kept for the listed years.

    Same rows as a full outer join of the two daily sums, computed as one
    aggregate over the tagged union of both feeds: a single shuffle on
    (Date, key), whose hash partitioning the panel's joins then reuse (a full
    outer join on coalesced keys would lose it).  The year filter runs before
    the shuffle."""
    parts = [_daily_counts(f, date=date, key=key, count=count).withColumn("_resp", F.lit(r))
             for f, r in ((respiratory, True), (asthma, False))]
    u = parts[0].unionByName(parts[1])
    if years is not None:
        u = filter_years(u, years=years)
    g = u.groupBy("Date", "borough").agg(
        F.coalesce(F.sum(F.when(F.col("_resp"), F.col("_c"))), F.lit(0.0)).alias("Respiratory_Count"),
        F.coalesce(F.sum(F.when(~F.col("_resp"), F.col("_c"))), F.lit(0.0)).alias("Asthma_Count"))
    return g.select("Date", "borough", "Respiratory_Count", "Asthma_Count",
                    (F.col("Respiratory_Count") + F.col("Asthma_Count")).alias("Total_Hospitalization"),
                    F.year("Date").alias("year"))


def visits_inner(respiratory: DataFrame, asthma: DataFrame, **cols) -> DataFrame:
    """Older path: inner join of the two daily sums (days present in both)."""
    r = visits_daily_sum(respiratory, name="Respiratory_Count", **cols)
    a = visits_daily_sum(asthma, name="Asthma_Count", **cols)
    return r.join(a, on=["Date", "borough"], how="inner")


def airq_pivot(df: DataFrame, *, date: str = "Start_Date", key: str = "Geo Place Name",
               name: str = "Name", value: str = "Data Value",
               names: Sequence[str] | None = None, prefix: str = "AQ_", places: int | None = None) -> DataFrame:
    """Long -> wide: mean of each named measure per (Date, borough), columns
    renamed by ``sanitize_name``.

    Pass ``names`` to avoid the extra job that discovers them; measures outside
    ``names`` are left out by the caller's choice (``unlisted_measures`` counts them).
    ``places``: the decimals that readings carry; they are then summed as whole
    numbers and divided once, so a mean does not depend on the order of its rows.  As in a pandas
    pivot table, cells only come from rows that exist and rows whose measures
    are all missing are dropped.
    """
    d = parse_date(date) if dict(df.dtypes).get(date) == "string" else F.col(date).cast("date")
    long = df.select(d.alias("Date"), canonical_key(key).alias("borough"),
                     F.col(name).alias("_name"), nan_to_null(value).alias("_v")) \
             .where(F.col("Date").isNotNull() & F.col("borough").isNotNull()
                    & F.col("_name").isNotNull() & F.col("_v").isNotNull())
    if names is None:
        # bounded: one row per distinct measure name
        names = sorted(r[0] for r in long.select("_name").distinct().collect())
    names = list(names)
    # one conditional aggregate per name: a single shuffle on (Date, borough),
    # where pivot() would first aggregate by (Date, borough, name) and shuffle twice
    def mean(n: str) -> Column:
        if places is None:
            return F.avg(F.when(F.col("_name") == n, F.col("_v")))
        units = F.sum(F.when(F.col("_name") == n, F.round(F.col("_v") * 10.0 ** places).cast("long")))
        return F.try_divide(units.cast("double"), F.count_if(F.col("_name") == n) * F.lit(10.0 ** places))

    wide = long.groupBy("Date", "borough").agg(*[mean(n).alias(sanitize_name(n, prefix)) for n in names])
    # a pivot table only has cells for rows that exist: drop rows with no measure
    cols = [sanitize_name(n, prefix) for n in names]
    return wide.where(F.greatest(*[F.col(c).isNotNull() for c in cols]) if len(cols) > 1
                      else F.col(cols[0]).isNotNull())


def unlisted_measures(df: DataFrame, names: Sequence[str], *, name: str = "Name") -> DataFrame:
    """(measure, n_rows) of the readings that a pivot over ``names`` does not use; a missing name counts too."""
    return df.where(F.col(f"`{name}`").isNull() | ~F.col(f"`{name}`").isin(*names)) \
             .groupBy(F.col(f"`{name}`").alias("measure")).agg(F.count(F.lit(1)).alias("n_rows"))


def drop_empty_columns(df: DataFrame, *, protect: Iterable[str] = ()) -> DataFrame:
    """Drop all-missing columns.  One-row profile (count per column), then select."""
    keep = set(protect)
    cand = [c for c in df.columns if c not in keep]
    if not cand:
        return df
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cand]).first()
    return df.drop(*[c for c in cand if row[c] == 0])


PROTECTED = ("Date", "borough", "Total_Hospitalization", "Respiratory_Count", "Asthma_Count")


def drop_constant_zero_columns(df: DataFrame, *, protect: Iterable[str] = PROTECTED) -> DataFrame:
    """Drop columns that are all missing or all zero (protected ones stay).
    One pass computes, per column, the non-null and the zero counts; a column
    holding zeros and missing values is neither, so it stays."""
    keep = set(protect)
    cand = [c for c in df.columns if c not in keep]
    num = set(numeric_columns(df))
    aggs = [F.count(F.lit(1)).alias("n__")]
    for c in cand:
        aggs.append(F.count(F.col(f"`{c}`")).alias(f"n__{c}"))
        if c in num:
            aggs.append(F.count_if(F.col(f"`{c}`") == 0).alias(f"z__{c}"))
    if not cand:
        return df
    row = df.agg(*aggs).first()
    drop = [c for c in cand if row[f"n__{c}"] == 0 or (c in num and row[f"z__{c}"] == row["n__"])]
    return df.drop(*drop)
