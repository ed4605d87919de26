import datetime as dt

from pyspark.sql import functions as F

from surge.operators.features import calendar_features, quantile_value, standardize
from surge.operators.series import additive_decompose, three_month_means


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 6),)], "Date date")
    got = [(r.day_of_week, r.is_weekend) for r in calendar_features(df).orderBy("Date").collect()]
    assert got == [(0, 0), (5, 1)]


def test_quantile_is_linear(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    assert df.select(quantile_value(df, "x", 0.75)).first()[0] == 3.25


def test_three_month_bins_anchor_on_first_month_end(spark):
    df = spark.createDataFrame([(dt.date(2017, 1, 15), 1.0), (dt.date(2017, 3, 1), 2.0), (dt.date(2017, 7, 2), 4.0)],
                               "Date date, v double")
    got = [(r.Date, r.v) for r in three_month_means(df, ["v"]).orderBy("Date").collect()]
    assert got == [(dt.date(2017, 1, 31), 1.0), (dt.date(2017, 4, 30), 2.0), (dt.date(2017, 7, 31), 4.0)]


def test_standardize_population_std_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    got = standardize(df, ["a", "c"]).orderBy("a").collect()
    assert [r.a for r in got] == [-1.0, 1.0] and [r.c for r in got] == [0.0, 0.0]


def test_additive_decomposition_adds_up(spark):
    d0 = dt.date(2020, 1, 1)
    vals = [10 + (i % 7) * 2 + i * 0.1 for i in range(40)]
    df = spark.createDataFrame([("k", d0 + dt.timedelta(i), v) for i, v in enumerate(vals)],
                               "borough string, Date date, v double")
    out = additive_decompose(df, value="v").orderBy("Date").collect()
    assert [r.trend for r in out[:3]] == [None] * 3 and out[-1].trend is None
    for r in out[3:-3]:
        assert abs(r.trend + r.seasonal + r.resid - r.observed) < 1e-9
    seas = {}
    for i, r in enumerate(out):
        seas.setdefault(i % 7, set()).add(round(r.seasonal, 9))
    assert all(len(s) == 1 for s in seas.values())
    assert abs(sum(next(iter(s)) for s in seas.values())) < 1e-9
    assert F is not None


def test_stl_recovers_weekly_season(spark):
    import numpy as np
    from surge.operators.stl import stl_decompose, stl_numpy
    n = 140
    season_true = np.tile([3.0, -1.0, 0.5, -2.0, 1.0, -0.5, -1.0], n // 7)
    y = 50 + 0.05 * np.arange(n) + season_true
    t, s, r = stl_numpy(y)
    assert np.allclose(t + s + r, y)
    assert np.abs(s[14:-14] - season_true[14:-14]).max() < 0.3
    d0 = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("k", d0 + dt.timedelta(i), float(v)) for i, v in enumerate(y)],
                               "borough string, Date date, v double")
    out = stl_decompose(df, value="v").toPandas()
    assert len(out) == n and np.allclose(out.trend + out.seasonal + out.resid, out.observed)
