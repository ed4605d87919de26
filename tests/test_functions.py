import math

from pyspark.sql import functions as F

from surge.functions.columns import coerce_numeric, rowwise_mean, sanitize_name, season


def test_coerce_numeric_traps(spark):
    raw = ["12", " 5 ", "1,234", "abc", "", "1e3", "1.0d", None, "2F", "NaN"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(coerce_numeric("v")).collect()]
    assert got == [12.0, 5.0, None, None, None, 1000.0, None, None, None, None]


def test_sanitize_name_rule():
    assert sanitize_name("Visits due to PM2.5") == "AQ_Visits_due_to_PM25"
    assert sanitize_name("Particles (PM 2.5)") == "AQ_Particles_PM_25"


def test_rowwise_mean_skips_missing(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    got = [r[0] for r in df.select(rowwise_mean(["a", "b", "c"])).collect()]
    assert got[0] == 2.0 and got[1] is None


def test_season_map(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    got = [r[0] for r in df.orderBy("m").select(season("m")).collect()]
    assert got == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 1]
    assert not math.isnan(got[0])
