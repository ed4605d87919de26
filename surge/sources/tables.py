"""Readers for the driver's parquet tables and the reference-shaped views over them.

The reference reads four CSV feeds (weather, respiratory visits, asthma visits,
long-format air quality) plus a station catalogue and scoring requests.  The
test tables are TPC-H-like, so each feed is *derived* from them by Spark
(joins + projections); the work grows with the tables.  The same derivations
are written in DuckDB SQL in ``oracle_queries.py``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed values of the mapping (FIXTURES.md section 4).
RESPIRATORY_PRIORITIES = ("1-URGENT", "2-HIGH")
AIRQ_NAME_BY_FLAG = {"A": "Visits due to PM2.5", "N": "Ozone (O3)"}
AIRQ_OTHER_NAME = "Nitrogen dioxide (NO2)"
#: Decimals of an air-quality reading.
AIRQ_PLACES = 5
VALID_PLACES = ("automobile", "building", "furniture", "household", "machinery")
KEEP_YEARS = (1995, 1996, 1997, 1998, 2000, 2001)
TRAIN_YEARS = (1995, 1996, 1997, 1998)
VAL_YEARS = (2000,)
TEST_YEARS = (2001,)
REQUEST_EPOCH = "1995-01-01"
# Station catalogue: (place, priority, station_id); 'X*' stations never land rows.
STATION_CATALOGUE = (
    ("building", 1, "X1"), ("building", 2, "3"),
    ("machinery", 1, "1"),
    ("furniture", 1, "2"),
    ("household", 1, "X2"), ("household", 2, "0"),
    ("automobile", 1, "4"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _orders_with_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                               "o_totalprice", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey)


def orders_with_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's place and nation (raw columns)."""
    o = table(spark, sf_dir, "orders")
    return o.join(table(spark, sf_dir, "customer"), o.o_custkey == F.col("c_custkey"))


def visits_raw(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Visit-count feed (respiratory or asthma) in the reference's shape:
    ``Date``, ``Dim1Value`` (raw place text), ``Count`` (text)."""
    is_resp = F.col("o_orderpriority").isin(*RESPIRATORY_PRIORITIES)
    df = _orders_with_place(spark, sf_dir).where(is_resp if kind == "respiratory" else ~is_resp)
    return df.select(
        F.col("o_orderdate").cast("date").alias("Date"),
        F.col("c_mktsegment").alias("Dim1Value"),
        F.floor(F.col("o_totalprice") / 10000).cast("bigint").cast("string").alias("Count"),
    )


def _lines_with_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_shipdate")
    return li.join(_orders_with_place(spark, sf_dir).select("o_orderkey", "c_mktsegment"),
                   li.l_orderkey == F.col("o_orderkey"))


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather feed, one row per reading: ``DATE``, weather codes, ``borough``, ``year``."""
    df = _lines_with_place(spark, sf_dir)
    d = F.col("l_shipdate").cast("date")
    return df.select(
        d.alias("DATE"),
        F.col("l_quantity").cast("double").alias("TMAX"),
        (F.col("l_quantity") - 20).cast("double").alias("TMIN"),
        (30 + 10 * F.col("l_linenumber")).cast("double").alias("RHAV"),
        (F.col("l_discount") * 100).cast("double").alias("AWND"),
        F.col("c_mktsegment").alias("borough"),
        F.year(d).alias("year"),
    )


def airq_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-format air quality: ``Start_Date``, ``Geo Place Name``, ``Name``, ``Data Value``."""
    df = _lines_with_place(spark, sf_dir)
    name = F.when(F.col("l_returnflag") == "A", AIRQ_NAME_BY_FLAG["A"]) \
            .when(F.col("l_returnflag") == "N", AIRQ_NAME_BY_FLAG["N"]) \
            .otherwise(AIRQ_OTHER_NAME)
    return df.select(
        F.col("l_shipdate").cast("date").alias("Start_Date"),
        F.col("c_mktsegment").alias("Geo Place Name"),
        name.alias("Name"),
        (F.col("l_extendedprice") / 1000).cast("double").alias("Data Value"),
    )


def series_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series per key from ``events``: (Date, key, value) with the day sum."""
    ev = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    return (ev.groupBy(F.col("ts").cast("date").alias("Date"), F.col("event_type").alias("key"))
              .agg(F.sum("value").alias("value")))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests: request_id, borough (text), date (yyyy-MM-dd text), capacity."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    place = F.when(F.col("c_nationkey") == 0, F.lit("unknown")).otherwise(F.lower(F.col("c_mktsegment")))
    day = F.date_add(F.lit(REQUEST_EPOCH).cast("date"), ((F.col("c_custkey") * 37) % 2600).cast("int"))
    return c.select(
        F.col("c_custkey").alias("request_id"),
        place.alias("borough"),
        F.date_format(day, "yyyy-MM-dd").alias("date"),
        (20 + F.col("c_nationkey")).cast("int").alias("capacity"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows for the metric operators: id, model, dataset, label, score, y, yhat."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value")
    part = F.col("user_id") % 5
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("model"),
        F.when(part <= 2, "Train").when(part == 3, "Val").otherwise("Test").alias("dataset"),
        (F.col("value") >= 50).cast("int").alias("label"),
        (((F.col("event_id") * 7919) % 100) / 100.0).cast("double").alias("score"),
        F.col("value").cast("double").alias("y"),
        (F.col("value") * 0.8 + (F.col("event_id") * 31) % 20).cast("double").alias("yhat"),
    )


def station_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATION_CATALOGUE), "borough string, priority int, station_id string")


def landed_station_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather rows as landed per station: a line's supplier nation is the station."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity", "l_linenumber")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    d = F.col("l_shipdate").cast("date")
    return li.join(s, li.l_suppkey == s.s_suppkey).select(
        F.col("s_nationkey").cast("string").alias("STATION"),
        d.alias("DATE"),
        F.year(d).alias("year"),
        F.col("l_quantity").cast("double").alias("TMAX"),
        (30 + 10 * F.col("l_linenumber")).cast("double").alias("RHAV"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding rows for kNN: id, features (array<double>), label (0/1), is_train."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("features"),
        (F.col("label") >= 5).cast("int").alias("label"),
        (F.col("vec_id") % 5 < 4).alias("is_train"),
    )
