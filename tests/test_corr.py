import math
import random

import numpy as np
import pandas as pd
import pytest

from surge.operators import profile as prof


def frame(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = rng.gauss(1e6, 0.01)
        rows.append((a, rng.choice([None, -2 * a + rng.gauss(0, 0.02)]), rng.randrange(5), 0.1, rng.choice([math.nan, rng.gauss(0, 1)]),
                     None, 7.0 if i % 2 else None, 3.0 if i % 2 == 0 else None))
    return rows


@pytest.mark.parametrize("parts", [1, 5])
def test_matrix_equals_pandas(spark, parts):
    """Pairwise complete, large means, NaN as missing; NULL for constant, empty and never jointly present columns."""
    names = ["a", "b", "c", "same", "e", "none", "odd", "even"]
    df = spark.createDataFrame(frame(400, 3), "a double, b double, c int, same double, e double, none double, odd double, even double").repartition(parts)
    got = {(r["var1"], r["var2"]): r["corr"] for r in prof.corr_matrix(df, names).collect()}
    plain = pd.DataFrame([[np.nan if v is None else float(v) for v in r] for r in df.collect()], columns=names)
    want = plain.assign(a=plain["a"] - 1e6, b=plain["b"] + 2e6).corr()  # shifted, where pandas loses digits
    assert len(got) == 64
    for x in names:
        for y in names:
            fixed = {x, y} & {"same", "none", "odd", "even"}
            if fixed:
                assert got[x, y] is None
            else:
                assert got[x, y] == pytest.approx(want.loc[x, y], abs=1e-9)


def test_one_pass_and_no_rows(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert {r["corr"] for r in prof.corr_matrix(df, ["a", "b"]).collect()} == {None} and prof.corr_matrix(df, ["a", "b"]).count() == 4
    plan = prof.co_moments(spark.range(10).selectExpr("double(id) a", "double(id % 3) b"), ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "Exchange" not in plan and "Generate" not in plan
    top = prof.corr_target_top(spark.range(50).selectExpr("double(id) a", "double(-id) b", "double(id % 7) c"), "a", ["a", "b", "c"], k=2).collect()
    assert [r["variable"] for r in top][0] == "a" and len(top) == 2
