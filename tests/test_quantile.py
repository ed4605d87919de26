import datetime as dt
import math
import random

import numpy as np
import pytest

from surge.operators import quantile
from surge.operators.series import winsorize


@pytest.mark.parametrize("small", [3, 10_000])
def test_equals_linear_quantiles(spark, small):
    """Any size of the last part gives numpy's linear quantiles: ties, skew, extremes, groups of one."""
    rng = random.Random(small)
    groups = {"a": [rng.gauss(0, 1) for _ in range(900)], "b": [1.0] * 300 + [2.0] * 2, "c": [5.5],
              "d": [math.exp(rng.gauss(0, 40)) for _ in range(400)], "e": [float(rng.randrange(4)) for _ in range(500)],
              "f": [-1.7e308, 1.7e308, 0.0, 1e-300], "g": [None, math.nan]}
    rows = [(k, v, -v if v is not None else None) for k, vs in groups.items() for v in vs] + [("a", None, None), ("a", math.nan, math.nan), (None, 3.0, 3.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(4)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r["k"], r["variable"], r["p"]): r["value"] for r in quantile.exact_quantiles(df, ["x", "y"], probs, keys=["k"], small=small).collect()}
    assert {k for k, _, _ in got} == set("abcdef") and len(got) == 6 * 2 * len(probs)
    for k in "abcde":
        for p in probs:
            for name, values in (("x", groups[k]), ("y", [-v for v in groups[k]])):
                assert got[k, name, p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-300)


def test_no_keys_and_no_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "v double")
    assert df.limit(1).select(quantile.quantile_value(df, "v", 0.75).alias("q")).first()["q"] == 3.25
    none = df.where("v > 9")
    assert quantile.exact_quantiles(none, ["v"], [0.5]).count() == 0
    assert df.limit(1).select(quantile.quantile_value(none, "v", 0.5).alias("q")).first()["q"] is None


def test_winsorize_keeps_keys_without_values(spark):
    rows = [("a", dt.date(2020, 1, 1), float(v)) for v in [1, 2, 3, 4, 100]] + [("b", dt.date(2020, 1, 1), None)]
    out = winsorize(spark.createDataFrame(rows, "borough string, Date date, v double"), value="v")
    assert sorted((r["borough"], r["v"]) for r in out.collect() if r["v"] is not None) == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("a", 7.0)]
    assert [r["v"] for r in out.collect() if r["borough"] == "b"] == [None]


def test_no_exact_percentile_on_rows(spark):
    """The plan of a sought quantile has no percentile aggregate."""
    df = spark.range(1000).selectExpr("cast(id as double) v", "id % 3 k")
    plan = quantile.exact_quantiles(df, ["v"], [0.5], keys=["k"])._jdf.queryExecution().toString()
    assert "percentile(" not in plan.lower()


def test_ranks_of_longs(spark):
    from pyspark.sql import functions as F
    rng = random.Random(2)
    groups = {"a": [rng.randrange(-2 ** 63, 2 ** 63) for _ in range(700)], "b": [5] * 40, "c": [2 ** 62 + 1, 2 ** 62 + 3, 2 ** 62 + 2]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [(None, 1), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(3)
    ranks = {"none": F.lit(0), "first": F.lit(1), "half": F.ceil(F.col("n") / 2), "all": F.col("n")}
    got = {(r["k"], r["p"]): r["value"] for r in quantile.rank_values(df, "k", "v", ranks, small=4).collect()}
    for k, vs in groups.items():
        vs = sorted(vs)
        assert [got[k, p] for p in ranks] == [None, vs[0], vs[(len(vs) + 1) // 2 - 1], vs[-1]]


def test_stratified_split_is_exact_and_moves_no_rows(spark):
    from surge.operators.features import stratified_split
    df = spark.createDataFrame([(i, i % 3 if i % 10 else None) for i in range(1000)], "id long, y int").repartition(4).persist()
    out = stratified_split(df, label="y", id_cols=["id"])
    count = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    for y in range(3):
        n = sum(v for (k, _), v in count.items() if k == y)
        t = math.floor(n * 0.15 + 0.5)
        assert count[y, "test"] == t and count[y, "val"] == math.floor((n - t) * 0.176 + 0.5)
    assert count[None, None] == 100
    again = stratified_split(df.repartition(7), label="y", id_cols=["id"])
    assert sorted(map(tuple, out.select("id", "split").collect()), key=str) == sorted(map(tuple, again.select("id", "split").collect()), key=str)
    rows_plan = out._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in rows_plan and "Window" not in rows_plan
