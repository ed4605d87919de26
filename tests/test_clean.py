import datetime as dt

import pytest

from surge.operators.clean import drop_constant_zero_columns, health_daily, select_present, visits_daily_sum
from surge.sources.stations import stack_frames

D1, D2 = dt.date(2017, 1, 1), dt.date(2017, 1, 2)


def test_all_unparsable_group_sums_to_zero_and_missing_keys_dropped(spark):
    rows = [(D1, "Bronx", "abc"), (D1, " BRONX ", ""), (D1, None, "5"), (None, "bronx", "7"), (D2, "bronx", "3")]
    df = spark.createDataFrame(rows, "Date date, Dim1Value string, Count string")
    got = {(r.Date, r.borough): r.Count for r in visits_daily_sum(df).collect()}
    assert got == {(D1, "bronx"): 0.0, (D2, "bronx"): 3.0}


def test_full_outer_join_one_sided_days(spark):
    resp = spark.createDataFrame([(D1, "queens", "4")], "Date date, Dim1Value string, Count string")
    asth = spark.createDataFrame([(D2, "queens", "2")], "Date date, Dim1Value string, Count string")
    got = {r.Date: (r.Respiratory_Count, r.Asthma_Count, r.Total_Hospitalization, r.year)
           for r in health_daily(resp, asth, years=[2017]).collect()}
    assert got == {D1: (4.0, 0.0, 4.0, 2017), D2: (0.0, 2.0, 2.0, 2017)}


def test_drop_constant_zero_columns(spark):
    df = spark.createDataFrame([(D1, 0.0, None, 0.0, 1.0), (D2, 0.0, None, None, 0.0)],
                               "Date date, zeros double, empty double, zero_or_missing double, live double")
    assert drop_constant_zero_columns(df).columns == ["Date", "zero_or_missing", "live"]


def test_select_present_lenient_and_strict(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert select_present(df, ["c", "x", "a"]).columns == ["c", "a"]
    with pytest.raises(ValueError, match="x"):
        select_present(df, ["a", "x"], strict=True)


def test_stacked_frames_keep_all_columns(spark):
    one = spark.createDataFrame([(1, 2.0)], "a int, b double")
    two = spark.createDataFrame([("z", 5)], "c string, a int")
    got = stack_frames([one, two, one.limit(0)])
    assert got.columns == ["a", "b", "c"] and sorted(map(tuple, got.collect())) == [(1, 2.0, None), (5, None, "z")]
