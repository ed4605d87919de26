"""Station selection with ordered fallback over already-landed weather rows.

The reference asks a weather service station by station until one returns
data.  Here every station's rows are already landed; a borough takes the
highest-priority catalogue station that has *any* rows, found with one
aggregate over the landed rows and a join - no per-borough loop.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def station_year_coverage(landed: DataFrame, catalogue: DataFrame, *, station: str = "STATION",
                          year: str = "year") -> DataFrame:
    """Rows per (catalogue station, year); empty station-years are simply absent."""
    cat = catalogue.select(F.col("station_id").alias(station)).distinct()
    return landed.join(cat, on=[station], how="left_semi").groupBy(station, year).agg(
        F.count(F.lit(1)).alias("n_rows"))


def station_fallback(landed: DataFrame, catalogue: DataFrame, *, station: str = "STATION") -> DataFrame:
    """(borough, station_id, priority) of the first station in priority order with
    any landed row; boroughs without one drop out.  Ties in priority go to the
    smaller station id.  The window runs over the catalogue (a few rows per borough)."""
    has = landed.select(F.col(station).alias("station_id")).distinct()
    ok = catalogue.join(has, on=["station_id"], how="left_semi")
    w = Window.partitionBy("borough").orderBy("priority", "station_id")
    return ok.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def union_station_years(landed: DataFrame, selection: DataFrame, *, station: str = "STATION",
                        date: str = "DATE") -> DataFrame:
    """The selected station's rows for each borough, tagged with borough (and year)."""
    sel = selection.select("borough", F.col("station_id").alias(station))
    return landed.join(sel, on=[station], how="inner")


def stack_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack per-station / per-year frames whose columns differ (missing -> NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
