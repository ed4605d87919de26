"""Named queries over the driver tables: each takes (spark, sf_dir) -> DataFrame.

The shared pieces (health, weather, air quality, panel) are functions, so each
query is one lazy plan that Catalyst optimises end to end.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surge.functions.columns import canonical_key, coerce_numeric, parse_date, parse_dates, rowwise_mean, sanitize_name_expr
from surge.operators import clean
from surge.operators import features as feat
from surge.operators import impact as imp_
from surge.operators import impute as imp
from surge.operators import metrics as met
from surge.operators import models as mdl
from surge.operators import panel as pnl
from surge.operators import profile as prof
from surge.operators import scoring as sc
from surge.operators import series as ser
from surge.operators import smooth
from surge.operators import stl as stl_
from surge.operators.quantile import quantile_table
from surge.plans.stage import materialize
from surge.session import delete_at_exit, ensure_checkpoint_dir, scratch_path
from surge.sources import feeds, sinks
from surge.sources import stations as st
from surge.sources import tables as src

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

AIRQ_NAMES = sorted([*src.AIRQ_NAME_BY_FLAG.values(), src.AIRQ_OTHER_NAME])


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Presentation step for comparisons: doubles rounded to ``places``."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), places).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


# ---------------------------------------------------------------- building blocks

def health(spark: SparkSession, sf: str) -> DataFrame:
    return clean.health_daily(src.visits_raw(spark, sf, "respiratory"), src.visits_raw(spark, sf, "asthma"),
                              years=src.KEEP_YEARS)


def weather(spark: SparkSession, sf: str) -> DataFrame:
    return clean.weather_clean(src.weather_raw(spark, sf))


def airq(spark: SparkSession, sf: str) -> DataFrame:
    return clean.airq_pivot(src.airq_raw(spark, sf), names=AIRQ_NAMES, places=src.AIRQ_PLACES)


def panel(spark: SparkSession, sf: str) -> DataFrame:
    return pnl.panel_merged(health(spark, sf), weather(spark, sf), airq(spark, sf),
                            valid_keys=src.VALID_PLACES)


# ---------------------------------------------------------------- sources and cleaning

def _landed(spark: SparkSession, rows: DataFrame, feed: feeds.Feed) -> DataFrame:
    """Stand-in for a shipped feed: the rows landed as CSV in the shared folder, read back with the feed's schema."""
    path = scratch_path(spark, f"feed-{feed.name}")
    feeds.write_feed(rows, path)
    delete_at_exit(spark, path)
    return feeds.read_feed(spark, path, feed)


def _visit_file(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """The visit file of a kind: ISO days for one, month-first days for the other, columns the feed does not declare."""
    day = F.date_format("Date", "yyyy-MM-dd" if kind == "respiratory" else "M/d/yyyy")
    return src.visits_raw(spark, sf, kind).select(F.lit(kind).alias("Metric"), "Dim1Value", "Count", F.lit("x,y").alias("Note"), day.alias("Date"))


@query("src_visits")
def q_src_visits(spark, sf):
    """Both visit files, landed as CSV with their own date formats and read with the declared schema."""
    parts = []
    for kind in ("respiratory", "asthma"):
        v = feeds.accepted(_landed(spark, _visit_file(spark, sf, kind), feeds.VISITS))
        parts.append(v.select("Date", F.col("Dim1Value").alias("borough"), coerce_numeric("Count").alias("Count"), F.lit(kind).alias("kind")))
    return parts[0].unionByName(parts[1])


@query("src_weather_daily")
def q_src_weather_daily(spark, sf):
    """The weather file (station days), landed as CSV and read with the declared schema."""
    w = feeds.accepted(_landed(spark, src.weather_raw(spark, sf), feeds.WEATHER))
    return w.select(F.col("DATE").alias("Date"), "borough", "TMAX", "TMIN", "RHAV", "AWND", "year")


@query("src_airq_long")
def q_src_airq_long(spark, sf):
    """The air-quality file (every reading), landed as CSV with month-first times and read with the declared schema."""
    rows = src.airq_raw(spark, sf).withColumn("Start_Date", F.date_format("Start_Date", "MM/dd/yyyy hh:mm:ss a"))
    a = feeds.accepted(_landed(spark, rows, feeds.AIR_QUALITY))
    return a.select(F.col("Start_Date").alias("Date"), F.col("Geo Place Name").alias("borough"), "Name", F.col("Data Value").alias("value"))


@query("stack_station_files")
def q_stack_station_files(spark, sf):
    """Station files of two periods, the earlier one without humidity, landed as CSV and stacked."""
    rows = src.landed_station_rows(spark, sf).withColumn("borough", F.concat(F.lit("station "), "STATION"))
    paths = []
    for part in (rows.where(F.col("year") < 1998).drop("RHAV"), rows.where(F.col("year") >= 1998).select("RHAV", "DATE", "STATION", "TMAX", "borough", "year")):
        paths.append(scratch_path(spark, "feed-stations"))
        feeds.write_feed(part, paths[-1])
        delete_at_exit(spark, paths[-1])
    return feeds.accepted(feeds.read_feeds(spark, paths, feeds.WEATHER)).select("STATION", "DATE", "year", "TMAX", "RHAV")


@query("feed_rejects")
def q_feed_rejects(spark, sf):
    """Issues of a visit file and of an air-quality file with open orders' days, missing places and text readings, counted by kind."""
    o = src.orders_with_place(spark, sf)
    visits = o.select(
        F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(F.date_format("o_orderdate", "M/d/yyyy")).alias("Date"),
        F.when(F.col("c_nationkey") != 0, F.col("c_mktsegment")).alias("Dim1Value"), F.col("o_orderpriority").alias("Count"))
    air = src.airq_raw(spark, sf).select(
        F.when(F.col("Name") != src.AIRQ_OTHER_NAME, F.col("Start_Date").cast("string")).alias("Start_Date"), "Geo Place Name", "Name",
        F.when(F.col("Data Value") > 50, F.lit("over")).otherwise(F.col("Data Value").cast("string")).alias("Data Value"))
    counts = [feeds.reject_counts(_landed(spark, rows, feed)).select(F.lit(feed.name).alias("feed"), "issue", "n_rows")
              for rows, feed in ((visits, feeds.VISITS), (air, feeds.AIR_QUALITY))]
    return counts[0].unionByName(counts[1])


@query("unlisted_measures")
def q_unlisted_measures(spark, sf):
    """Readings of measures that a pivot over the first listed pollutant alone would leave out."""
    return clean.unlisted_measures(src.airq_raw(spark, sf), AIRQ_NAMES[:1])


@query("parse_dates_lenient")
def q_parse_dates(spark, sf):
    o = src.table(spark, sf, "orders")
    forms = ["yyyy-MM-dd", "M/d/yyyy", "MM/dd/yyyy hh:mm:ss a", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd", "d MMM yyyy"]
    mixed = F.element_at(F.array(*[F.date_format("o_orderdate", f) for f in forms], F.lit("13/13/2001")),
                         (F.pmod("o_orderkey", F.lit(len(forms) + 1)) + 1).cast("int"))
    return o.select("o_orderkey",
                    parse_date(F.col("o_orderdate").cast("string")).alias("parsed_date"),
                    parse_date("o_orderstatus").alias("parsed_status"),
                    parse_date(F.date_format("o_orderdate", "dd/MM/yyyy"), "dd/MM/yyyy").alias("parsed_fmt"),
                    parse_dates(F.concat(F.lit(" "), mixed)).alias("parsed_mixed"))


@query("key_canonical")
def q_key_canonical(spark, sf):
    c = src.table(spark, sf, "customer")
    return c.select("c_custkey", canonical_key(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("key"))


@query("coerce_numeric")
def q_coerce_numeric(spark, sf):
    e = src.table(spark, sf, "events")
    return e.select("event_id",
                    coerce_numeric(F.regexp_extract("props", r":(.*)\}", 1)).alias("k_num"),
                    coerce_numeric("props").alias("props_num"),
                    coerce_numeric(F.concat(F.col("event_id").cast("string"), F.lit("d"))).alias("suffix_num"),
                    coerce_numeric(F.format_number("value", 2)).alias("grouped_num"))


@query("sanitize_names")
def q_sanitize_names(spark, sf):
    a = src.airq_raw(spark, sf)
    return a.select("Name").distinct().select("Name", sanitize_name_expr("Name").alias("column_name"))


@query("filter_years")
def q_filter_years(spark, sf):
    v = src.visits_raw(spark, sf, "respiratory")
    return clean.filter_years(v, years=src.TEST_YEARS + src.VAL_YEARS, date="Date") \
        .select("Date", canonical_key("Dim1Value").alias("borough"), coerce_numeric("Count").alias("Count"))


@query("filter_valid_keys")
def q_filter_valid_keys(spark, sf):
    return clean.filter_valid_keys(src.requests(spark, sf), keys=src.VALID_PLACES)


@query("visits_daily_sum")
def q_visits_daily_sum(spark, sf):
    return clean.visits_daily_sum(src.visits_raw(spark, sf, "respiratory"), name="Respiratory_Count")


@query("visits_inner")
def q_visits_inner(spark, sf):
    return clean.visits_inner(src.visits_raw(spark, sf, "respiratory"), src.visits_raw(spark, sf, "asthma"))


@query("health_daily")
def q_health_daily(spark, sf):
    return health(spark, sf)


@query("weather_clean")
def q_weather_clean(spark, sf):
    return weather(spark, sf)


@query("airq_pivot")
def q_airq_pivot(spark, sf):
    return airq(spark, sf)


@query("panel_weather_left")
def q_panel_weather_left(spark, sf):
    return pnl.panel_weather_left(health(spark, sf), weather(spark, sf))


@query("panel_merged")
def q_panel_merged(spark, sf):
    return panel(spark, sf)


# ---------------------------------------------------------------- imputation, lags, features


WEATHER_VARS = ["Temp_Max_C", "Humidity_Avg", "WindSpeed_mps", "Temp_Min_C"]


def imputed(spark: SparkSession, sf: str) -> DataFrame:
    """Main path: panel -> per-key fill (+ mean, 0) -> drop all-missing / all-zero columns.

    The panel and the filled panel are stage boundaries (checkpointed): the fill,
    its mean subquery and the column profile each read the panel, and at scale
    re-deriving it would mean re-scanning the raw feeds."""
    return imp.impute_and_prune(materialize(panel(spark, sf)))


def features(spark: SparkSession, sf: str) -> DataFrame:
    """Main path features: calendar, one-hot (key kept), frame lags 1/7, ranges, target."""
    df = imputed(spark, sf)
    df = feat.calendar_features(df)
    df = feat.one_hot_key(df, values=src.VALID_PLACES)
    df = feat.lag_features_frame(df)
    df = feat.range_features(df)
    df = materialize(df.where(F.col("Total_Hospitalization").isNotNull()))
    return feat.high_risk_target(df)


@query("impute_series")
def q_impute_series(spark, sf):
    return imputed(spark, sf)


@query("impute_frame")
def q_impute_frame(spark, sf):
    return imp.impute_frame(clean.drop_empty_columns(panel(spark, sf)))


@query("interpolate_limited")
def q_interpolate_limited(spark, sf):
    s = ser.daily_spine(health(spark, sf), value="Total_Hospitalization", gap="null")
    return imp.interpolate_limited(s, ["Total_Hospitalization"], limit=3)


@query("lag_features_series")
def q_lag_features_series(spark, sf):
    p = panel(spark, sf).select("Date", "borough", *WEATHER_VARS)
    return feat.lag_features_series(p, WEATHER_VARS[:3], lags=(1, 2, 3))


@query("lag_features_frame")
def q_lag_features_frame(spark, sf):
    p = panel(spark, sf).drop("AQ_Nitrogen_dioxide_NO2", "AQ_Ozone_O3", "AQ_Visits_due_to_PM25")
    return feat.lag_features_frame(p)


@query("rolling_mean_shift")
def q_rolling_mean_shift(spark, sf):
    p = panel(spark, sf).select("Date", "borough", "Total_Hospitalization", "Temp_Max_C", "Humidity_Avg")
    return feat.rolling_mean_shift(p, ["Total_Hospitalization", "Temp_Max_C", "Humidity_Avg"])


@query("calendar_features")
def q_calendar_features(spark, sf):
    return feat.calendar_features(health(spark, sf).drop("year")).select(
        "Date", "borough", "year", "month", "day", "day_of_week", "quarter", "is_weekend", "season")


@query("one_hot_key")
def q_one_hot_key(spark, sf):
    return feat.one_hot_key(health(spark, sf).select("Date", "borough"), values=src.VALID_PLACES)


@query("range_features")
def q_range_features(spark, sf):
    return feat.range_features(weather(spark, sf)).select("Date", "borough", "Temp_Range")


@query("quantile_threshold")
def q_quantile_threshold(spark, sf):
    q = quantile_table(health(spark, sf), ["Total_Hospitalization"], [0.25, 0.5, 0.75])
    return q.select(*[F.col(f"q{i}").alias(f"p{p}") for i, p in enumerate((25, 50, 75))])


@query("high_risk_target")
def q_high_risk_target(spark, sf):
    return feat.high_risk_target(panel(spark, sf)).select("Date", "borough", "Total_Hospitalization", "High_Risk")


@query("temporal_split")
def q_temporal_split(spark, sf):
    return feat.temporal_split(health(spark, sf), train_years=src.TRAIN_YEARS, val_years=src.VAL_YEARS,
                               test_years=src.TEST_YEARS).select("Date", "borough", "split")


@query("features")
def q_features(spark, sf):
    return features(spark, sf)


@query("feature_matrix")
def q_feature_matrix(spark, sf):
    f = feat.temporal_split(features(spark, sf), train_years=src.TRAIN_YEARS, val_years=src.VAL_YEARS,
                            test_years=src.TEST_YEARS)
    return feat.feature_matrix(f.where(F.col("split").isNotNull()))


@query("standardize")
def q_standardize(spark, sf):
    f = feat.temporal_split(features(spark, sf), train_years=src.TRAIN_YEARS, val_years=src.VAL_YEARS,
                            test_years=src.TEST_YEARS).where(F.col("split").isNotNull())
    cols = ["Temp_Max_C", "Humidity_Avg", "WindSpeed_mps", "day_of_week", "borough_building"]
    return feat.standardize(f, cols, fit_on=f.where(F.col("split") == "train"), suffix="_z") \
        .select("Date", "borough", "split", *[c + "_z" for c in cols])


@query("feature_manifest")
def q_feature_manifest(spark, sf):
    f = features(spark, sf)
    return feat.feature_manifest(spark, feat.feature_columns(f))


# ---------------------------------------------------------------- exploration / series

def series_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Daily total per place with gaps (the health panel, valid places)."""
    return health(spark, sf).where(F.col("borough").isin(*src.VALID_PLACES)) \
        .select("Date", "borough", "Total_Hospitalization", "Asthma_Count")


@query("daily_spine_sum")
def q_daily_spine_sum(spark, sf):
    return ser.daily_spine(series_panel(spark, sf), value="Total_Hospitalization", gap="zero")


@query("min_length_series")
def q_min_length_series(spark, sf):
    s = src.series_long(spark, sf).withColumnRenamed("key", "borough")
    return ser.min_length_series(s, value="value", min_days=14)


@query("winsorize_iqr")
def q_winsorize_iqr(spark, sf):
    return ser.winsorize(series_panel(spark, sf), value="Total_Hospitalization", method="iqr")


@query("winsorize_percentile")
def q_winsorize_percentile(spark, sf):
    return ser.winsorize(series_panel(spark, sf), value="Total_Hospitalization", method="percentile")


@query("winsor_log_series")
def q_winsor_log_series(spark, sf):
    return ser.winsor_log_series(series_panel(spark, sf), value="Total_Hospitalization")


@query("additive_decompose")
def q_additive_decompose(spark, sf):
    s = ser.daily_spine(series_panel(spark, sf), value="Asthma_Count", gap="zero")
    return ser.additive_decompose(s, value="Asthma_Count")


@query("weather_linear_fit")
def q_weather_linear_fit(spark, sf):
    return ser.weather_linear_fit(panel(spark, sf), targets=["Total_Hospitalization", "Asthma_Count"],
                                  variables=["Temp_Max_C", "Temp_Min_C", "WindSpeed_mps", "Humidity_Avg"])


@query("monthly_means")
def q_monthly_means(spark, sf):
    return ser.monthly_means(panel(spark, sf), ["Total_Hospitalization", "Asthma_Count", "Temp_Max_C"])


@query("three_month_means")
def q_three_month_means(spark, sf):
    return ser.three_month_means(panel(spark, sf), ["Total_Hospitalization", "Asthma_Count", "Temp_Max_C"])


@query("monthly_by_key")
def q_monthly_by_key(spark, sf):
    return ser.monthly_by_key(panel(spark, sf), sums=["Total_Hospitalization", "Respiratory_Count"],
                              means=["Temp_Max_C", "Humidity_Avg", "WindSpeed_mps"])


@query("monthly_join_back")
def q_monthly_join_back(spark, sf):
    p = panel(spark, sf).select("Date", "borough", "Respiratory_Count", "Temp_Max_C", "Humidity_Avg")
    return pnl.monthly_join_back(p, sums=["Respiratory_Count"], means=["Temp_Max_C", "Humidity_Avg"])


# ---------------------------------------------------------------- impact (un-imputed panel) and profiling


PANEL_NUMERIC = ["Respiratory_Count", "Asthma_Count", "Total_Hospitalization", "Temp_Max_C", "Temp_Min_C",
                 "Humidity_Avg", "WindSpeed_mps", "AQ_Nitrogen_dioxide_NO2", "AQ_Ozone_O3", "AQ_Visits_due_to_PM25"]


@query("extreme_flag")
def q_extreme_flag(spark, sf):
    return imp_.extreme_flag(panel(spark, sf)).select("Date", "borough", "is_extreme")


@query("extreme_totals")
def q_extreme_totals(spark, sf):
    return imp_.extreme_totals(panel(spark, sf))


@query("extreme_uplift_by_key")
def q_extreme_uplift_by_key(spark, sf):
    return imp_.extreme_uplift_by_key(panel(spark, sf))


@query("temperature_impact")
def q_temperature_impact(spark, sf):
    return imp_.temperature_impact(panel(spark, sf))


@query("humidity_impact")
def q_humidity_impact(spark, sf):
    return imp_.humidity_impact(panel(spark, sf))


@query("high_exposure_days")
def q_high_exposure_days(spark, sf):
    p = panel(spark, sf)
    return imp_.high_exposure_days(p, imp_.pm_columns(p)).select("Date", "borough", "exposure", "is_high")


@query("high_pm_totals")
def q_high_pm_totals(spark, sf):
    p = panel(spark, sf)
    return imp_.high_exposure_totals(p, imp_.pm_columns(p))


@query("high_aq_totals")
def q_high_aq_totals(spark, sf):
    p = panel(spark, sf)
    return imp_.high_exposure_totals(p, imp_.aq_composite_columns(p))


@query("pm_uplift_by_key")
def q_pm_uplift_by_key(spark, sf):
    p = panel(spark, sf)
    return imp_.exposure_uplift_by_key(p, imp_.pm_columns(p))


@query("key_ranking")
def q_key_ranking(spark, sf):
    return imp_.key_ranking(panel(spark, sf))


@query("totals_by_key")
def q_totals_by_key(spark, sf):
    return imp_.key_ranking(panel(spark, sf)).select("borough", "total_cases", "rank")


@query("daily_avg_by_key")
def q_daily_avg_by_key(spark, sf):
    return imp_.key_ranking(panel(spark, sf)).select("borough", "avg_daily_cases", "n_rows")


@query("breakdown_by_key")
def q_breakdown_by_key(spark, sf):
    return imp_.key_ranking(panel(spark, sf)).select("borough", "asthma_cases", "respiratory_cases", "total_cases")


@query("share_of_total")
def q_share_of_total(spark, sf):
    return imp_.key_ranking(panel(spark, sf)).select("borough", "share_pct")


@query("regional_summary")
def q_regional_summary(spark, sf):
    return imp_.regional_summary(panel(spark, sf))


@query("regional_headline")
def q_regional_headline(spark, sf):
    return imp_.regional_headline(panel(spark, sf))


@query("missing_profile")
def q_missing_profile(spark, sf):
    return prof.missing_profile(panel(spark, sf))


@query("describe_numeric")
def q_describe_numeric(spark, sf):
    return prof.describe_numeric(weather(spark, sf), ["Temp_Max_C", "Temp_Min_C", "Humidity_Avg", "WindSpeed_mps"])


@query("value_counts")
def q_value_counts(spark, sf):
    return prof.value_counts(feat.high_risk_target(panel(spark, sf)), "High_Risk")


@query("data_summary")
def q_data_summary(spark, sf):
    return prof.data_summary(panel(spark, sf))


@query("corr_matrix")
def q_corr_matrix(spark, sf):
    return prof.corr_matrix(panel(spark, sf), PANEL_NUMERIC)


@query("corr_target_top")
def q_corr_target_top(spark, sf):
    p = panel(spark, sf)
    tops = [prof.corr_target_top(p, target, PANEL_NUMERIC, k=10).select(F.lit(target).alias("target"), "variable", "corr")
            for target in ("Total_Hospitalization", "Respiratory_Count")]
    return tops[0].unionByName(tops[1])


@query("corr_listwise")
def q_corr_listwise(spark, sf):
    return prof.corr_listwise(panel(spark, sf), PANEL_NUMERIC)


@query("corr_target_filtered")
def q_corr_target_filtered(spark, sf):
    p = panel(spark, sf).select("Date", "borough", "Respiratory_Count", *WEATHER_VARS[:3])
    lagged = feat.lag_features_series(p, WEATHER_VARS[:3], lags=(1, 2, 3))
    lagged = pnl.monthly_join_back(lagged, sums=["Respiratory_Count"], means=WEATHER_VARS[:3])
    cols = [c for c in lagged.columns if c not in ("Date", "borough", "Respiratory_Count")]
    return prof.corr_target_filtered(lagged, "Respiratory_Count", cols)


@query("service_stats")
def q_service_stats(spark, sf):
    return prof.service_stats(imputed(spark, sf))


# ---------------------------------------------------------------- metrics on scored rows



def model_order(spark: SparkSession, sf: str) -> list[str]:
    """Model list order for tie-breaks: the scored models' names, sorted (a handful)."""
    return sorted(r[0] for r in src.scored(spark, sf).select("model").distinct().collect())


@query("classification_metrics")
def q_classification_metrics(spark, sf):
    return met.classification_metrics(src.scored(spark, sf))


@query("auroc")
def q_auroc(spark, sf):
    return met.auroc(src.scored(spark, sf))


@query("regression_metrics")
def q_regression_metrics(spark, sf):
    return met.regression_metrics(src.scored(spark, sf))


@query("roc_curve")
def q_roc_curve(spark, sf):
    return met.roc_curve(src.scored(spark, sf).where(F.col("dataset") == "Test"))


@query("confusion_matrix")
def q_confusion_matrix(spark, sf):
    return met.confusion_matrix(src.scored(spark, sf))


def _best(spark, sf):
    s = src.scored(spark, sf)
    order = model_order(spark, sf)
    bc = met.best_by(met.classification_metrics(s), metric="AUROC", order=order)
    br = met.best_by(met.regression_metrics(s), metric="R2", order=order)
    return s, bc, br


@query("best_model")
def q_best_model(spark, sf):
    _, bc, br = _best(spark, sf)
    return bc.select(F.lit("classification").alias("task"), "model", F.lit("AUROC").alias("metric"),
                     F.col("AUROC").alias("value")).unionByName(
        br.select(F.lit("regression").alias("task"), "model", F.lit("R2").alias("metric"), F.col("R2").alias("value")))


@query("residuals")
def q_residuals(spark, sf):
    s, _, br = _best(spark, sf)
    rows = s.where(F.col("dataset") == "Test").join(br.select("model"), on="model", how="left_semi")
    return met.residuals(rows)


def _written(spark: SparkSession, rows: DataFrame, name: str, partition_by: str, again) -> DataFrame:
    """A result written as a partitioned table, the partitions of ``again`` rewritten by a second run, and the table read back."""
    path = scratch_path(spark, f"result-{name}")
    rows = materialize(rows)
    sinks.write_partitions(rows, path, partition_by=partition_by, run="first")
    sinks.write_partitions(rows.where(again), path, partition_by=partition_by, run="second")
    delete_at_exit(spark, path)
    return sinks.read_committed(spark, path, partition_by=partition_by).select(*rows.columns)


@query("sink_classification_results")
def q_sink_classification(spark, sf):
    return _written(spark, met.classification_metrics(src.scored(spark, sf)), "classification", "dataset", F.col("dataset") == "Test")


@query("sink_regression_results")
def q_sink_regression(spark, sf):
    return _written(spark, met.regression_metrics(src.scored(spark, sf)), "regression", "dataset", F.col("dataset") != "Train")


@query("sink_components")
def q_sink_components(spark, sf):
    """The decomposition of every place, one partition each; the second run rewrites one place and leaves the others."""
    return _written(spark, q_additive_decompose(spark, sf), "components", "borough", F.col("borough") == src.VALID_PLACES[0])


@query("key_findings")
def q_key_findings(spark, sf):
    p = panel(spark, sf)
    pm = imp_.exposure_uplift_by_key(p, imp_.pm_columns(p)).select(
        F.concat(F.lit("pm25_uplift_pct_"), "borough").alias("finding"), F.col("pct_change").alias("value"))
    t = imp_.temperature_impact(p).where(F.col("measure") == "Total_Hospitalization").select(
        F.concat("exposure", F.lit("_total_pct")).alias("finding"), F.col("pct_change").alias("value"))
    h = imp_.humidity_impact(p).where(F.col("measure") == "Asthma_Count").select(
        F.lit("humidity_asthma_pct").alias("finding"), F.col("pct_change").alias("value"))
    _, bc, br = _best(spark, sf)
    m = bc.select(F.explode(F.array(
        F.struct(F.lit("best_clf_accuracy").alias("finding"), F.col("Accuracy").alias("value")),
        F.struct(F.lit("best_clf_auroc").alias("finding"), F.col("AUROC").alias("value")))).alias("r")).select("r.*")
    r = br.select(F.explode(F.array(
        F.struct(F.lit("best_reg_r2").alias("finding"), F.col("R2").alias("value")),
        F.struct(F.lit("best_reg_mae").alias("finding"), F.col("MAE").alias("value")))).alias("r")).select("r.*")
    return pm.unionByName(t).unionByName(h).unionByName(m).unionByName(r)


# ---------------------------------------------------------------- scoring of request batches



def validated(spark: SparkSession, sf: str) -> DataFrame:
    return sc.validate_requests(src.requests(spark, sf), valid_keys=src.VALID_PLACES)


def history(spark: SparkSession, sf: str) -> DataFrame:
    """Scoring history: the imputed panel (one row per key and day)."""
    return imputed(spark, sf)


@query("validate_requests")
def q_validate_requests(spark, sf):
    return validated(spark, sf)


@query("nearest_date_join")
def q_nearest_date_join(spark, sf):
    r = validated(spark, sf).select("request_id", "borough", "req_date")
    return sc.nearest_date_join(r, history(spark, sf))


@query("historical_average")
def q_historical_average(spark, sf):
    return sc.answer_all(validated(spark, sf), lambda ok: sc.historical_average(
        ok.select("request_id", "borough", "req_date"), history(spark, sf)))


@query("cascade_features")
def q_cascade_features(spark, sf):
    return sc.answer_all(validated(spark, sf), lambda ok: sc.cascade_features(
        ok.select("request_id", "borough", "req_date"), history(spark, sf), WEATHER_VARS[:3]))


@query("risk_band")
def q_risk_band(spark, sf):
    s = src.scored(spark, sf)
    return s.select("id", "model", "dataset", sc.risk_band(F.col("score")).alias("risk_band"),
                    sc.binary_band(met.predicted_class(F.col("score"))).alias("binary_band"))


def _fallback(ok: DataFrame, hist: DataFrame) -> DataFrame:
    return sc.score_fallback(sc.historical_average(ok.select("request_id", "borough", "req_date", "capacity"), hist))


@query("score_fallback")
def q_score_fallback(spark, sf):
    return sc.answer_all(validated(spark, sf), lambda ok: sc.response_record(_fallback(ok, history(spark, sf))))


@query("score_capacity")
def q_score_capacity(spark, sf):
    h = history(spark, sf)

    def answer(ok: DataFrame) -> DataFrame:
        f = _fallback(ok, h).withColumnRenamed("expected_admissions", "predicted_count")
        means = h.groupBy("borough").agg(F.avg("Total_Hospitalization").alias("key_mean"))
        out = sc.score_capacity(f.join(means, on="borough", how="left"), key_mean="key_mean")
        return out.select("request_id", "borough", "req_date", "capacity", "predicted_count", "additional_beds_needed",
                          "utilization_percent", "capacity_status", "vs_key_mean_pct")

    return sc.answer_all(validated(spark, sf), answer)


@query("score_error_fallback")
def q_score_error_fallback(spark, sf):
    v = validated(spark, sf).select("request_id", "borough", "req_date")
    h = history(spark, sf)
    near = sc.nearest_date_join(v, h).join(
        h.select("borough", F.col("Date").alias("matched_date"), F.col("Total_Hospitalization").alias("_t")),
        on=["borough", "matched_date"], how="left")
    pred = near.select("request_id", "borough", "req_date",
                       F.when(F.col("day_gap") == 0, F.col("_t")).alias("expected_admissions"),
                       F.lit(None).cast("double").alias("risk_probability"),
                       F.lit("Model").alias("risk_level"), F.lit("High (ML Model)").alias("confidence"))
    out = sc.score_error_fallback(sc.historical_average(pred, h))
    return out.select("request_id", "success", "expected_admissions", "risk_level", "confidence", "historical_average")


@query("score_interpretation")
def q_score_interpretation(spark, sf):
    return sc.answer_all(validated(spark, sf), lambda ok: sc.score_interpretation(_fallback(ok, history(spark, sf))).select(
        "request_id", "rounded_admissions", "diff_vs_history", "abs_diff_rounded", "direction", "pct_vs_history", "advice"))


# ---------------------------------------------------------------- station selection (landed weather rows)



@query("station_fallback")
def q_station_fallback(spark, sf):
    return st.station_fallback(src.landed_station_rows(spark, sf), src.station_catalogue(spark))


@query("station_year_coverage")
def q_station_year_coverage(spark, sf):
    return st.station_year_coverage(src.landed_station_rows(spark, sf), src.station_catalogue(spark))


@query("union_station_years")
def q_union_station_years(spark, sf):
    landed = src.landed_station_rows(spark, sf)
    sel = st.station_fallback(landed, src.station_catalogue(spark))
    return st.union_station_years(landed, sel).select("borough", "STATION", "DATE", "year", "TMAX", "RHAV")


# ---------------------------------------------------------------- models (rows-only checks, except kNN)



def prepared(spark: SparkSession, sf: str) -> DataFrame:
    f = feat.temporal_split(features(spark, sf), train_years=src.TRAIN_YEARS, val_years=src.VAL_YEARS,
                            test_years=src.TEST_YEARS).where(F.col("split").isNotNull())
    cols = feat.feature_columns(f)
    return mdl.prepare(feat.feature_matrix(f, features=cols), cols)


def _clf(name):
    return lambda spark, sf: mdl.train_classifiers(prepared(spark, sf), names=[name])


def _reg(name):
    return lambda spark, sf: mdl.train_regressors(prepared(spark, sf), names=[name])


for _key, _name in (("clf_logistic", "Logistic Regression"), ("clf_tree", "Decision Tree"),
                    ("clf_forest", "Random Forest"), ("clf_gbt", "Gradient Boosting"), ("clf_svm", "SVM")):
    QUERIES[_key] = _clf(_name)
for _key, _name in (("reg_ridge", "Ridge Regression"), ("reg_lasso", "Lasso Regression"),
                    ("reg_forest", "Random Forest Regressor"), ("reg_gbt", "Gradient Boosting Regressor")):
    QUERIES[_key] = _reg(_name)


@query("model_comparison")
def q_model_comparison(spark, sf):
    p = prepared(spark, sf)
    c = mdl.train_classifiers(p).select("model", "dataset", F.lit("classification").alias("task"),
                                        F.col("AUROC").alias("score"))
    r = mdl.train_regressors(p).select("model", "dataset", F.lit("regression").alias("task"),
                                       F.col("R2").alias("score"))
    return c.unionByName(r)


@query("clf_knn")
def q_clf_knn(spark, sf):
    v = src.vectors(spark, sf)
    out = mdl.knn_predict(v.where("is_train"), v.where(~F.col("is_train")), k=5)
    return out.withColumn("predicted", (F.col("probability") > 0.5).cast("int"))


@query("stratified_split")
def q_stratified_split(spark, sf):
    f = materialize(features(spark, sf))
    s = feat.stratified_split(f, label="High_Risk", id_cols=["Date", "borough"])
    return s.groupBy("High_Risk", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query("rebuild_model")
def q_rebuild_model(spark, sf):
    """Small-feature rebuild: the merged panel handed over as a CSV file (written
    to the shared checkpoint folder, re-read with a declared schema and the
    date re-parsed), calendar + weather features, both boosted models on all
    rows (train metrics)."""
    from surge.sources.sinks import read_table, write_table
    panel_df = imputed(spark, sf)
    path = scratch_path(spark, "panel-csv")
    write_table(panel_df, path, fmt="csv")
    delete_at_exit(spark, path)
    text_schema = T.StructType([T.StructField(c, T.StringType() if c == "Date" else t)
                                for c, t in ((f.name, f.dataType) for f in panel_df.schema.fields)])
    reread = read_table(spark, path, fmt="csv", schema=text_schema).withColumn("Date", parse_date("Date", "yyyy-MM-dd"))
    f = feat.calendar_features(reread)
    f = feat.high_risk_target(f, inclusive=False).withColumn("split", F.lit("train"))
    cols = ["month", "day", "day_of_week", "Temp_Max_C", "Humidity_Avg"]
    p = mdl.prepare(feat.feature_matrix(f, features=cols), cols)
    c = mdl.train_classifiers(p, names=["Gradient Boosting"]).select(
        "model", "dataset", F.col("AUROC").alias("score"))
    r = mdl.train_regressors(p, names=["Gradient Boosting Regressor"]).select(
        "model", "dataset", F.col("R2").alias("score"))
    return c.unionByName(r)


# ---------------------------------------------------------------- STL and model-based scoring



@query("stl_decompose")
def q_stl_decompose(spark, sf):
    """Robust STL of both measures' prepared series (gaps, winsorised, clipped, log1p), for places with enough days."""
    p = materialize(clean.filter_valid_keys(health(spark, sf), keys=src.VALID_PLACES))
    parts = []
    for measure in ("Respiratory_Count", "Asthma_Count"):
        s = ser.min_length_series(ser.winsor_log_series(p.select("Date", "borough", measure), value=measure), value=measure, min_days=14)
        parts.append(stl_.stl_decompose(s, value=measure).select(F.lit(measure).alias("measure"), "*"))
    return parts[0].unionByName(parts[1])


def _feature_table(spark, sf):
    f = feat.temporal_split(features(spark, sf), train_years=src.TRAIN_YEARS, val_years=src.VAL_YEARS,
                            test_years=src.TEST_YEARS).where(F.col("split").isNotNull())
    cols = feat.feature_columns(f)
    return feat.feature_matrix(f, features=cols), cols


def bundle_root(spark: SparkSession, sf: str) -> str:
    """Where the bundles of a data folder are, below the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/bundles/{hashlib.sha256(sf.encode()).hexdigest()[:16]}"


def publish(spark: SparkSession, sf: str) -> int:
    """The training job: fit both scoring pairs on the feature table and publish them with the history they were made from."""
    fm, cols = _feature_table(spark, sf)
    fm = materialize(fm)
    models = {name: mdl.fit_pipeline(fm, cols, kind=kind, name=name, label=label) for kind, label, names in (
        ("classifier", "High_Risk", ("Random Forest", "Gradient Boosting")),
        ("regressor", "Total_Hospitalization", ("Random Forest Regressor", "Gradient Boosting Regressor"))) for name in names}
    root = bundle_root(spark, sf)
    number = sinks.publish_bundle(root, models=models, features=cols, history=fm, extra={"targets": ["High_Risk", "Total_Hospitalization"]})
    delete_at_exit(spark, root)
    return number


def bundle(spark: SparkSession, sf: str):
    """The newest published bundle of a data folder; the training job runs first where none is published."""
    found = sinks.latest_bundle(spark, bundle_root(spark, sf))
    if found is None:
        publish(spark, sf)
        found = sinks.latest_bundle(spark, bundle_root(spark, sf))
    return found


@query("train_bundle")
def q_train_bundle(spark, sf):
    """Publishes a version of the bundle and reads its manifest back: models with their stages, features in order, rows of history."""
    publish(spark, sf)
    models, features, hist, manifest = bundle(spark, sf)
    rows = [(name, [type(s).__name__ for s in m.stages], len(features), features[0], features[-1]) for name, m in sorted(models.items())]
    told = spark.createDataFrame(rows, "model string, stages array<string>, n_features int, first_feature string, last_feature string")
    return told.select("model", F.array_join("stages", ",").alias("stages"), "n_features", "first_feature", "last_feature",
                       hist.agg(F.count(F.lit(1)).alias("n")).select("n").scalar().alias("history_rows"))


#: Tasks over which the asked days are dealt for scoring: few rows, each with many trees to walk.
SCORING_TASKS = 48


def _scored_days(rows: DataFrame, classifier_model, regressor_model) -> DataFrame:
    """``score_requests`` of one row per asked (key, day)."""
    return mdl.score_requests(rows.repartition(SCORING_TASKS, "borough", "req_date"), classifier_model, regressor_model)


@query("score_nearest")
def q_score_nearest(spark, sf):
    """Nearest-day features -> the published forests' probability and count -> capacity and band; rejected requests get their error."""
    models, features, hist, _ = bundle(spark, sf)

    def answer(ok: DataFrame) -> DataFrame:
        near = sc.nearest_date_join(sc.asked_days(ok), hist.select("borough", "Date"))
        rows = near.join(hist.select("borough", F.col("Date").alias("matched_date"), *features), on=["borough", "matched_date"], how="left")
        told = _scored_days(rows, models["Random Forest"], models["Random Forest Regressor"]).select(
            "borough", "req_date", "matched_date", "day_gap", "predicted_count", "high_risk_probability")
        out = sc.score_capacity(ok.select("request_id", "borough", "req_date", "capacity").join(told, ["borough", "req_date"]))
        return out.select("request_id", "borough", "req_date", "matched_date", "day_gap", "predicted_count",
                          "high_risk_probability", "capacity", "additional_beds_needed", "utilization_percent",
                          sc.risk_band(F.col("high_risk_probability")).alias("risk_level"))

    return sc.answer_all(validated(spark, sf), answer)


@query("score_cascade")
def q_score_cascade(spark, sf):
    """Exact-day / month-mean / zero features -> the published boosted models -> binary band and count; rejected requests get their error."""
    models, features, hist, _ = bundle(spark, sf)

    def answer(ok: DataFrame) -> DataFrame:
        rows = sc.cascade_features(sc.asked_days(ok), hist, features)
        told = _scored_days(rows, models["Gradient Boosting"], models["Gradient Boosting Regressor"]).select(
            "borough", "req_date", "match_level", "predicted_count", "high_risk_probability", sc.binary_band(F.col("risk_pred")).alias("risk_level"))
        return ok.select("request_id", "borough", "req_date").join(told, ["borough", "req_date"]).select(
            "request_id", "borough", "req_date", "match_level", "predicted_count", "high_risk_probability", "risk_level")

    return sc.answer_all(validated(spark, sf), answer)


# ---------------------------------------------------------------- remaining cleaning / exploration entries


# A configured pollutant list may name measures a feed never reports (its column is then all missing).
AIRQ_CONFIGURED = AIRQ_NAMES + ["Fine particles (PM 2.5)"]


@query("drop_empty_columns")
def q_drop_empty_columns(spark, sf):
    wide = clean.airq_pivot(src.airq_raw(spark, sf), names=AIRQ_CONFIGURED, places=src.AIRQ_PLACES)
    return clean.drop_empty_columns(wide, protect=["Date", "borough"])


@query("drop_constant_zero_columns")
def q_drop_constant_zero_columns(spark, sf):
    aq = clean.airq_pivot(src.airq_raw(spark, sf), names=AIRQ_CONFIGURED, places=src.AIRQ_PLACES)
    p = materialize(pnl.panel_merged(health(spark, sf), weather(spark, sf), aq, valid_keys=src.VALID_PLACES))
    return clean.drop_constant_zero_columns(imp.impute_series(p))


@query("airq_carry_forward")
def q_airq_carry_forward(spark, sf):
    aq = ["AQ_Nitrogen_dioxide_NO2", "AQ_Ozone_O3", "AQ_Visits_due_to_PM25"]
    p = panel(spark, sf).select("Date", "borough", *aq)
    return imp.impute_series(p, cols=aq)


@query("rowwise_mean")
def q_rowwise_mean(spark, sf):
    p = panel(spark, sf)
    return p.select("Date", "borough", rowwise_mean(["AQ_Nitrogen_dioxide_NO2", "AQ_Ozone_O3"]).alias("AQ_composite"))


@query("format_labels")
def q_format_labels(spark, sf):
    return sc.answer_all(validated(spark, sf), lambda ok: ok.select(
        "request_id", F.initcap("borough").alias("title_key"), F.upper("borough").alias("upper_key"),
        F.date_format("req_date", "yyyy-MM-dd").alias("iso_date"), F.date_format("req_date", "MMMM dd, yyyy").alias("long_date"),
        F.date_format("req_date", "EEEE").alias("weekday_name")))


SMOOTH_TARGETS = ("Respiratory_Count", "Asthma_Count")


@query("lowess_grid")
def q_lowess_grid(spark, sf):
    """LOWESS of both measures on temperature: daily rows, monthly means and three-month means."""
    p = materialize(panel(spark, sf).select("Date", "borough", "Temp_Max_C", *SMOOTH_TARGETS))
    cols = ["Temp_Max_C", *SMOOTH_TARGETS]
    series = {"daily": p, "monthly": ser.monthly_means(p, cols), "three_month": ser.three_month_means(p, cols)}
    parts = [smooth.lowess_grid(rows, x="Temp_Max_C", y=y).select(F.lit(name).alias("series"), F.lit(y).alias("target"), "x", "fit")
             for name, rows in series.items() for y in SMOOTH_TARGETS]
    return functools.reduce(DataFrame.unionByName, parts)


@query("bootstrap_band")
def q_bootstrap_band(spark, sf):
    """Bands of the least-squares lines of both measures on every weather variable."""
    p = materialize(panel(spark, sf).select(F.concat_ws("|", F.col("Date").cast("string"), "borough").alias("_rid"), *WEATHER_VARS, *SMOOTH_TARGETS))
    parts = [smooth.bootstrap_band(p, x=x, y=y, id_col="_rid", replicates=1000).select(F.lit(x).alias("variable"), F.lit(y).alias("target"), "x", "lower", "upper")
             for x in WEATHER_VARS for y in SMOOTH_TARGETS]
    return functools.reduce(DataFrame.unionByName, parts)
