import datetime as dt
import random

import numpy as np
import pandas as pd

from surge.operators.impute import impute_series, interpolate_limited
from surge.operators.ordered import fill, lag_rows, rolling_mean_rows, row_index


def _frame(spark, n=400, keys=("a", "b", "c"), seed=7):
    rnd = random.Random(seed)
    rows = []
    for k in keys:
        d = dt.date(2017, 1, 1)
        for _ in range(n):
            d += dt.timedelta(days=rnd.choice([1, 1, 1, 2, 40]))
            rows.append((k, d, None if rnd.random() < 0.4 else rnd.random()))
    return spark.createDataFrame(rows, "k string, Date date, v double"), pd.DataFrame(rows, columns=["k", "Date", "v"])


def test_fill_matches_pandas(spark):
    df, pdf = _frame(spark)
    got = fill(df, ["v"], keys=["k"], order=["Date"], direction="both").toPandas().sort_values(["k", "Date"])
    pdf = pdf.sort_values(["k", "Date"])
    want = pdf.groupby("k")["v"].transform(lambda x: x.ffill().bfill())
    assert list(got["v"].fillna(-1).round(12)) == list(want.fillna(-1).round(12))


def test_row_index_and_lags_match_pandas(spark):
    df, pdf = _frame(spark)
    idx = row_index(df, keys=["k"], order=["Date"]).toPandas().sort_values(["k", "Date"])
    assert list(idx["_rn"]) == list(pdf.sort_values(["k", "Date"]).groupby("k").cumcount() + 1)
    got = lag_rows(df, ["v"], [1, 7], keys=["k"], order=["Date"]).toPandas().sort_values(["k", "Date"])
    p = pdf.sort_values(["k", "Date"])
    for k in (1, 7):
        want = p.groupby("k")["v"].shift(k)
        assert list(got[f"v_lag{k}"].fillna(-1).round(12)) == list(want.fillna(-1).round(12))


def test_frame_lag_orders_by_date_then_key(spark):
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("b", d, 2.0), ("a", d, 1.0), ("a", d + dt.timedelta(1), 3.0)],
                               "k string, Date date, v double")
    got = {(r.k, r.Date): r.v_lag1 for r in lag_rows(df, ["v"], [1], order=["Date", "k"]).collect()}
    assert got == {("a", d): None, ("b", d): 1.0, ("a", d + dt.timedelta(1)): 2.0}


def test_interpolate_limit_3_both_directions(spark):
    vals = [None, 1, None, None, None, None, None, None, None, 9, None]
    d0 = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("x", d0 + dt.timedelta(i), None if v is None else float(v)) for i, v in enumerate(vals)],
                               "borough string, Date date, v double")
    got = [r.v for r in interpolate_limited(df, ["v"], limit=3).orderBy("Date").collect()]
    assert got == [1, 1, 2, 3, 4, None, 6, 7, 8, 9, 9]


def test_impute_series_backward_fill_global_mean_and_zero(spark):
    d0 = dt.date(2020, 1, 1)
    rows = [("a", d0, None, None), ("a", d0 + dt.timedelta(1), 2.0, None), ("b", d0, None, None),
            ("b", d0 + dt.timedelta(1), None, None), ("c", d0, 4.0, None)]
    df = spark.createDataFrame(rows, "borough string, Date date, x double, y double")
    got = {(r.borough, r.Date): (r.x, r.y) for r in impute_series(df).collect()}
    # a: backward fill; b: mean of the filled column (2, 2, 4) -> 8/3; y: all missing -> 0
    assert got[("a", d0)] == (2.0, 0.0)
    assert abs(got[("b", d0)][0] - 8 / 3) < 1e-12 and got[("b", d0)][1] == 0.0


def test_rolling_mean_shift_matches_pandas(spark):
    from surge.operators.features import rolling_mean_shift
    df, pdf = _frame(spark)
    df = df.withColumnRenamed("k", "borough")
    got = rolling_mean_shift(df, ["v"]).toPandas().sort_values(["borough", "Date"])
    p = pdf.sort_values(["k", "Date"])
    want = p.groupby("k")["v"].transform(lambda x: x.rolling(7, min_periods=1).mean().shift(3))
    assert list(got["v_roll7"].fillna(-1).round(12)) == list(want.fillna(-1).round(12))


def test_winsorize_iqr_matches_pandas_clip(spark):
    from surge.operators.series import winsorize
    df, pdf = _frame(spark)
    got = winsorize(df.withColumnRenamed("k", "borough"), value="v").toPandas().sort_values(["borough", "Date"])
    p = pdf.sort_values(["k", "Date"])

    def clip(s):
        q1, q3 = s.quantile(0.25), s.quantile(0.75)
        return s.clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    want = p.groupby("k")["v"].transform(clip)
    assert list(got["v"].fillna(-1).round(12)) == list(want.fillna(-1).round(12))


def test_daily_spine_zero_fills_gaps(spark):
    from surge.operators.series import daily_spine
    d0 = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("k", d0, 2.0), ("k", d0, None), ("k", d0 + dt.timedelta(3), 5.0),
                                ("k", d0 + dt.timedelta(4), None)], "borough string, Date date, v double")
    got = [r.v for r in daily_spine(df, value="v").orderBy("Date").collect()]
    assert got == [2.0, 0.0, 0.0, 5.0, 0.0]


def test_impute_and_prune_equals_two_step(spark):
    from surge.operators.clean import drop_constant_zero_columns
    from surge.operators.impute import impute_and_prune
    d0 = dt.date(2020, 1, 1)
    rows = [("a", d0, None, None, 0.0, 1.0), ("a", d0 + dt.timedelta(1), 2.0, None, None, 0.0),
            ("b", d0, None, None, 0.0, 0.0), ("c", d0, 4.0, None, None, 3.0)]
    df = spark.createDataFrame(rows, "borough string, Date date, x double, empty double, zeros double, "
                                     "Total_Hospitalization double")
    fused = impute_and_prune(df)
    two = drop_constant_zero_columns(impute_series(df))
    assert fused.columns == two.columns == ["borough", "Date", "x", "Total_Hospitalization"]
    key = lambda r: (r.borough, r.Date)
    assert sorted(map(tuple, fused.collect()), key=lambda t: (t[0], t[1])) == \
        sorted(map(tuple, two.collect()), key=lambda t: (t[0], t[1]))
    assert key is not None


def test_halo_over_short_and_empty_buckets(spark):
    """Buckets of one to three rows, months without rows, keys of one row: lags and frames equal pandas over the whole key."""
    import random
    rng = random.Random(12)
    rows = []
    for key in ("a", "b", "c"):
        day = dt.date(2020, 1, 15)
        for _ in range(40 if key != "c" else 1):
            rows.append((key, day, rng.choice([None, float(rng.randrange(50))]), rng.randrange(9)))
            day += dt.timedelta(days=rng.choice([1, 9, 25, 70]))
    df = spark.createDataFrame(rows, "k string, Date date, v double, n int").repartition(3)
    pdf = pd.DataFrame(rows, columns=["k", "Date", "v", "n"]).sort_values(["k", "Date"])
    got = lag_rows(df, ["v", "n"], [1, 7], keys=["k"]).toPandas().sort_values(["k", "Date"])
    for c in ("v", "n"):
        for k in (1, 7):
            np.testing.assert_array_equal(got[f"{c}_lag{k}"].astype(float).to_numpy(), pdf.groupby("k")[c].shift(k).astype(float).to_numpy())
    for window, shift in ((7, 1), (7, -3), (5, 0), (3, -4), (2, 6)):
        got = rolling_mean_rows(df, ["v"], window=window, shift=shift, keys=["k"], count_name="cnt").toPandas().sort_values(["k", "Date"])
        at = pdf.groupby("k")["v"].transform(lambda s: pd.Series(
            [pd.Series(s.to_numpy()[max(i - shift - window + 1, 0):max(i - shift + 1, 0)]).mean() for i in range(len(s))], index=s.index))
        np.testing.assert_allclose(got[f"v_roll{window}"].astype(float).to_numpy(), at.to_numpy(), rtol=1e-12)
        assert got["_rn"].tolist() == (pdf.groupby("k").cumcount() + 1).tolist()
    frame = lag_rows(df, ["v"], [3], order=["Date", "k"]).toPandas().sort_values(["Date", "k"])
    np.testing.assert_array_equal(frame["v_lag3"].astype(float).to_numpy(), pdf.sort_values(["Date", "k"])["v"].shift(3).astype(float).to_numpy())
    assert lag_rows(df.limit(0), ["v"], [1], keys=["k"]).count() == 0


def test_halo_reads_the_input_once(spark, tmp_path):
    """The job that makes the halo's stage scans the input once and shuffles its rows once."""
    df = spark.createDataFrame([("a", dt.date(2020, 1, 1), 1.0)], "k string, Date date, v double")
    df.write.parquet(str(tmp_path / "in"))
    seen = []
    import surge.operators.ordered as ordered
    keep = ordered.materialize
    ordered.materialize = lambda x: seen.append(x._jdf.queryExecution().executedPlan().toString()) or keep(x)
    try:
        out = rolling_mean_rows(spark.read.parquet(str(tmp_path / "in")), ["v"], keys=["k"])
    finally:
        ordered.materialize = keep
    assert len(seen) == 1 and seen[0].count("FileScan parquet") == 1 and seen[0].count("Exchange hashpartitioning") == 1
    assert "FileScan parquet" not in out._jdf.queryExecution().executedPlan().toString()
