"""Building the daily panel: health x weather x air quality on (Date, key)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surge.operators.clean import DEFAULT_KEYS, filter_valid_keys


def join_suffixed(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                  suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Equi-join on ``on``; non-key columns present on both sides get suffixes
    instead of becoming two ambiguous columns of one name."""
    on = list(on)
    clash = (set(left.columns) & set(right.columns)) - set(on)
    if clash:
        left = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
        right = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return left.join(right, on=on, how=how)


def panel_weather_left(health: DataFrame, weather: DataFrame, *,
                       on: Sequence[str] = ("Date", "borough")) -> DataFrame:
    """Every health day keeps its row; weather columns are NULL where absent."""
    return join_suffixed(health, weather, on, "left")


def panel_merged(health: DataFrame, weather: DataFrame, airq: DataFrame | None = None, *,
                 on: Sequence[str] = ("Date", "borough"), key: str = "borough",
                 valid_keys: Iterable[str] | None = DEFAULT_KEYS) -> DataFrame:
    """health LEFT JOIN weather LEFT JOIN air quality, then keep valid keys.

    All three inputs are aggregates grouped by the join keys, so the joins are
    co-partitioned; an empty air-quality side simply yields NULL columns.  The
    key filter is pushed by Catalyst below both left joins.
    """
    p = panel_weather_left(health, weather, on=on)
    if airq is not None:
        p = join_suffixed(p, airq, on, "left")
    if valid_keys is not None:
        p = filter_valid_keys(p, keys=valid_keys, key=key)
    return p


def monthly_join_back(df: DataFrame, *, key: str = "borough", date: str = "Date",
                      sums: Sequence[str] = (), means: Sequence[str] = (), suffix: str = "_monthly") -> DataFrame:
    """Sums (cases) and means (weather) per (key, month) joined back to every day of that month."""
    month = F.trunc(F.col(date), "MM")
    m = df.groupBy(F.col(key).alias(key), month.alias("_month")).agg(
        *[F.sum(c).alias(c + suffix) for c in sums], *[F.avg(c).alias(c + suffix) for c in means])
    return df.withColumn("_month", month).join(m, on=[key, "_month"], how="left").drop("_month")
