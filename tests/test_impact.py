import datetime as dt

from surge.operators.clean import weather_clean
from surge.operators.impact import extreme_uplift_by_key, temperature_impact

D = dt.date(2020, 7, 1)


def _panel(spark, rows):
    return spark.createDataFrame(rows, "Date date, borough string, Temp_Max_C double, Temp_Min_C double, "
                                       "Humidity_Avg double, Total_Hospitalization double, "
                                       "Respiratory_Count double, Asthma_Count double")


def test_missing_weather_is_a_normal_day(spark):
    rows = [(D, "q", 35.0, 20.0, 50.0, 10.0, 6.0, 4.0),       # hot
            (D, "q", None, None, None, 4.0, 2.0, 2.0),        # no weather: normal
            (D, "q", 20.0, 5.0, 50.0, 2.0, 1.0, 1.0)]         # normal
    r = extreme_uplift_by_key(_panel(spark, rows)).first()
    assert (r.n_extreme_rows, r.n_normal_rows) == (1, 2)
    assert r.extreme_avg == 10.0 and r.normal_avg == 3.0 and abs(r.pct_change - 700 / 3) < 1e-9


def test_zero_baseline_gives_null_change_and_rows_are_counted(spark):
    rows = [(D, "q", 35.0, 20.0, 50.0, 10.0, 6.0, 4.0), (D, "b", 35.0, 20.0, 50.0, 5.0, 1.0, 4.0),
            (D, "q", 20.0, 5.0, 50.0, 0.0, 0.0, 0.0)]
    t = {(r.exposure, r.measure): r for r in temperature_impact(_panel(spark, rows)).collect()}
    heat = t[("heat", "Total_Hospitalization")]
    assert heat.n_rows == 2 and heat.n_days == 1 and heat.baseline_avg == 0.0 and heat.pct_change is None
    assert ("cold", "Total_Hospitalization") not in t


def test_nan_weather_is_missing_at_ingest(spark):
    df = spark.createDataFrame([(D, " Queens ", float("nan")), (D, "QUEENS", 30.0)], "DATE date, borough string, TMAX double")
    r = weather_clean(df).first()
    assert r.borough == "queens" and r.Temp_Max_C == 30.0


def test_listwise_correlation_of_an_empty_frame_keeps_every_pair(spark):
    from surge.operators.profile import corr_listwise
    df = spark.createDataFrame([(1.0, None), (None, 2.0)], "a double, b double")
    got = {(r.var1, r.var2): r.corr for r in corr_listwise(df, ["a", "b"]).collect()}
    assert got == {("a", "a"): None, ("a", "b"): None, ("b", "a"): None, ("b", "b"): None}
