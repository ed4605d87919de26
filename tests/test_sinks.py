import datetime as dt
import tempfile

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler

import pytest
from pyspark.sql import functions as F

from surge.operators import models as mdl
from surge.operators.features import standardize
from surge.sources.sinks import (
    latest_bundle, load_bundle, publish_bundle, read_committed, read_table, save_bundle, write_partitions, write_table,
)


def test_partitioned_panel_round_trip(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), "bronx", 3.0), (dt.date(2020, 1, 2), "queens", 4.0)],
                               "Date date, borough string, Total_Hospitalization double")
    out = tempfile.mkdtemp(prefix="surge-sink-")
    write_table(df, out + "/panel", partition_by="borough")
    back = read_table(spark, out + "/panel")
    assert sorted(map(tuple, back.select("Date", "borough", "Total_Hospitalization").collect())) == \
        sorted(map(tuple, df.collect()))
    write_table(df, out + "/csv", fmt="csv")
    assert read_table(spark, out + "/csv", fmt="csv", schema=df.schema).count() == 2


def test_bundle_round_trip(spark):
    df = spark.createDataFrame([(0.0, 1.0, 0.0), (1.0, 3.0, 1.0), (0.5, 2.5, 1.0), (0.1, 0.5, 0.0)],
                               "a double, b double, label double")
    v = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    m = LogisticRegression(maxIter=10).fit(v)
    out = tempfile.mkdtemp(prefix="surge-bundle-")
    save_bundle(out, models={"Logistic Regression": m}, features=["a", "b"], history=df, extra={"scaler": {"a": 1}})
    models, feats, hist, manifest = load_bundle(spark, out)
    assert feats == ["a", "b"] and hist.count() == 4 and manifest["scaler"] == {"a": 1}
    p1 = [r.probability for r in m.transform(v).collect()]
    p2 = [r.probability for r in models["Logistic Regression"].transform(v).collect()]
    assert p1 == p2


def feature_rows(spark):
    rows = [(float(i % 7), float(i * i % 11), 3.0, float(i % 7 > 3), "train" if i % 4 else "test", i) for i in range(80)]
    return spark.createDataFrame(rows + [(None, 2.0, 3.0, 1.0, "train", 99)], "a double, b double, c double, label double, split string, id int")


def test_fitted_scaler_equals_standardize(spark):
    rows = feature_rows(spark).na.fill(0.0, ["a"])
    train = rows.where("split = 'train'")
    want = standardize(rows, ["a", "b", "c"], fit_on=train, suffix="__z").orderBy("id").collect()
    got = mdl.scaler_stage(train, ["a", "b", "c"]).transform(rows).orderBy("id").collect()
    for w, g in zip(want, got, strict=True):
        assert [g[c] for c in ("a__z", "b__z", "c__z")] == pytest.approx([w[c] for c in ("a__z", "b__z", "c__z")], abs=1e-12)


def test_published_pipeline_scores_alike(spark):
    """A job that loads the newest bundle scores raw rows as the training job does; half-written versions are not seen."""
    rows, cols = feature_rows(spark), ["a", "b", "c"]
    root = tempfile.mkdtemp(prefix="surge-bundle-") + "/root"
    assert latest_bundle(spark, root) is None
    clf = mdl.fit_pipeline(rows, cols, kind="classifier", name="Decision Tree", label="label")
    reg = mdl.fit_pipeline(rows, cols, kind="regressor", name="Ridge Regression", label="b")
    assert publish_bundle(root, models={"c": clf, "r": reg}, features=cols, history=rows) == 1
    assert publish_bundle(root, models={"c": clf, "r": reg}, features=cols, history=rows.limit(5)) == 2
    rows.write.parquet(root + "/v3/history")  # a version whose job died
    models, features, hist, manifest = latest_bundle(spark, root)
    assert features == cols and hist.count() == 5 and manifest["version"] == 2
    one = mdl.score_requests(rows.drop("label"), clf, reg)
    two = mdl.score_requests(rows.drop("label"), models["c"], models["r"])
    assert not [c for c in two.columns if c.endswith("__z")]
    pick = ["id", "high_risk_probability", "risk_pred", "predicted_count"]
    assert sorted(map(tuple, one.select(*pick).collect())) == sorted(map(tuple, two.select(*pick).collect()))
    assert two.count() == 81


def test_partitions_are_replaced_and_kept(spark):
    out = tempfile.mkdtemp(prefix="surge-result-") + "/t"
    first = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0), (None, 1, 4.0)], "k string, d int, v double")
    with pytest.raises(FileNotFoundError):
        read_committed(spark, out, partition_by="k")
    write_partitions(first, out, partition_by="k", run="r1")
    write_partitions(first.where("k = 'a' AND d = 2").withColumn("v", F.lit(9.0)), out, partition_by="k", run="r2")
    # rows of a run that died before its manifest
    first.withColumn("_run", F.lit("r3")).write.mode("append").partitionBy("k", "_run").parquet(out + "/rows")
    got = read_committed(spark, out, partition_by="k")
    assert sorted(((r["k"] or "", r["d"], r["v"]) for r in got.collect())) == [("", 1, 4.0), ("a", 2, 9.0), ("b", 1, 3.0)]
    write_partitions(first.where("k = 'b'").limit(0), out, partition_by="k", run="r4")  # an empty run replaces nothing
    assert read_committed(spark, out, partition_by="k").count() == 3
