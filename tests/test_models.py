"""Linear-model conversions against closed forms on a 60 x 3 random design,
blocked kNN against brute force, and the SVM approximation's shape."""

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from surge.operators.models import knn_predict, regressor

rng = np.random.default_rng(0)
X = rng.normal(size=(60, 3))
Y = X @ np.array([1.5, -2.0, 0.5]) + 3.0 + rng.normal(scale=0.5, size=60)


def _frame(spark):
    rows = [(float(a), float(b), float(c), float(y)) for (a, b, c), y in zip(X, Y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, label double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


def test_ridge_matches_closed_form(spark):
    alpha = 1.0
    m = regressor("Ridge Regression", 60, float(Y.std()), alpha).fit(_frame(spark))
    xc, yc = X - X.mean(0), Y - Y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-6)
    assert abs(m.intercept - (Y.mean() - X.mean(0) @ w)) < 1e-6


def test_lasso_matches_coordinate_descent(spark):
    alpha = 0.1
    m = regressor("Lasso Regression", 60, float(Y.std()), alpha).fit(_frame(spark))
    xc, yc = X - X.mean(0), Y - Y.mean()
    w = np.zeros(3)
    for _ in range(5000):
        for j in range(3):
            r = yc - xc @ w + xc[:, j] * w[j]
            rho = xc[:, j] @ r / 60
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / (xc[:, j] @ xc[:, j] / 60)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-4)


def test_blocked_knn_equals_brute_force(spark):
    pts = rng.normal(size=(90, 4))
    lab = (rng.random(90) > 0.5).astype(int)
    rows = [(i, [float(v) for v in p], int(y)) for i, (p, y) in enumerate(zip(pts, lab))]
    df = spark.createDataFrame(rows, "id long, features array<double>, label int")
    train, test = df.where(F.col("id") < 70), df.where(F.col("id") >= 70)
    got = {r.id: r.probability for r in knn_predict(train, test, k=5, rows_per_block=16).collect()}
    for q in range(70, 90):
        d = np.sqrt(((pts[:70] - pts[q]) ** 2).sum(1))
        nn = np.lexsort((np.arange(70), d))[:5]
        assert abs(got[q] - lab[nn].mean()) < 1e-12


def test_ball_tree_prunes_and_equals_brute_force():
    from surge.operators.models import BallTree
    r = np.random.default_rng(4)
    x = r.normal(size=(12, 5))[r.integers(12, size=3000)] * 20 + r.normal(size=(3000, 5))
    x[100:140] = x[100]  # ties
    y = (r.random(3000) > 0.5).astype(float)
    ids = r.permutation(3000)
    tree = BallTree(ids, x, y, 64)
    q = np.vstack([x[::37], r.normal(size=(20, 5)) * 30])
    votes, count = tree.nearest(q, 7)
    for i, p in enumerate(q):
        near = np.lexsort((ids, np.sqrt(((x - p) ** 2).sum(1))))[:7]
        assert abs(votes[i] - y[near].mean()) < 1e-12 and count[i] == 7
    few, n = BallTree(ids[:3], x[:3], y[:3], 64).nearest(q[:2], 7)
    assert n.tolist() == [3, 3] and abs(few[0] - y[:3].mean()) < 1e-12
    assert BallTree(ids[:0], x[:0], y[:0], 64).nearest(q[:2], 7)[1].tolist() == [0, 0]


def test_svm_class_is_the_side_of_the_margin(spark):
    from surge.operators.models import train_classifiers
    df = _frame(spark).withColumn("High_Risk", (F.col("label") > 4).cast("int")).withColumn("split", F.expr("if(rand(3) < 0.7, 'train', 'test')"))
    out = {(r["model"], r["dataset"]): r for r in train_classifiers(df.drop("label"), names=["SVM", "KNN"], dim=3).collect()}
    assert set(out) == {("SVM", "Train"), ("SVM", "Test"), ("KNN", "Train"), ("KNN", "Test")}
    assert out["SVM", "Train"]["Accuracy"] > 0.7 and out["KNN", "Train"]["AUROC"] > 0.8


def test_knn_deals_out_the_asked_rows(spark):
    from surge.operators.models import TASK_ROWS
    df = spark.range(2 * TASK_ROWS + 50, numPartitions=1).select("id", F.array(F.sin("id"), F.cos(F.col("id") * 3)).alias("features"), F.lit(1).alias("label"))
    out = knn_predict(df.where("id < 50"), df.where("id >= 50"))
    assert out.rdd.getNumPartitions() == 3 and out.count() == 2 * TASK_ROWS


def test_only_candidates_are_measured(monkeypatch):
    from surge.operators import models
    r = np.random.default_rng(5)
    x, q = r.normal(size=(20_000, 16)), r.normal(size=(40, 16))
    pairs = []
    keep = models.BallTree._keep_best
    monkeypatch.setattr(models.BallTree, "_keep_best", lambda self, q, rows, who, *rest: (pairs.append(len(who)), keep(self, q, rows, who, *rest)))
    y = (r.random(20_000) > 0.5).astype(float)
    votes, _ = models.BallTree(np.arange(20_000), x, y, 128).nearest(q, 5)
    near = [np.lexsort((np.arange(20_000), np.sqrt(((x - p) ** 2).sum(1))))[:5] for p in q]
    assert np.allclose(votes, [y[n].mean() for n in near])
    assert sum(pairs) < 40 * 20_000 / 100


def test_a_missing_component_costs_no_other_row_its_neighbours():
    from surge.operators.models import BallTree
    r = np.random.default_rng(6)
    x, q = r.normal(size=(300, 4)), r.normal(size=(20, 4))
    y = (r.random(300) > 0.5).astype(float)
    want, _ = BallTree(np.arange(299), x[:299], y[:299], 16).nearest(q, 5)
    x[299, 2], broken = np.nan, np.vstack([q, [np.nan] * 4])
    votes, count = BallTree(np.arange(300), x, y, 16).nearest(broken, 5)
    assert np.allclose(votes[:20], want) and count.tolist() == [5] * 20 + [0]


def test_knn_uses_every_labelled_row(spark):
    n, asked = 60_000, 40  # more than one block of labelled rows
    x = np.random.default_rng(7).normal(size=(n + asked, 2))
    y = (np.arange(n) % 3 == 0).astype(int)
    rows = [(i, [float(v) for v in p], int(y[i]) if i < n else 0) for i, p in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label int")
    got = {r.id: (r.probability, r.n_neighbours) for r in knn_predict(df.where(F.col("id") < n), df.where(F.col("id") >= n)).collect()}
    assert len(got) == asked
    for q in range(n, n + asked):
        near = np.lexsort((np.arange(n), np.sqrt(((x[:n] - x[q]) ** 2).sum(1))))[:5]
        assert abs(got[q][0] - y[near].mean()) < 1e-12 and got[q][1] == 5


def test_knn_by_many_blocks_equals_brute_force(spark):
    pts = np.random.default_rng(8).integers(0, 4, size=(90, 3)).astype(float)  # many ties
    lab = np.arange(90) % 2
    rows = [(i, [float(v) for v in p], int(v)) for i, (p, v) in enumerate(zip(pts, lab))]
    df = spark.createDataFrame(rows, "id long, features array<double>, label int").repartition(3)
    got = {r.id: r.probability for r in knn_predict(df.where("id < 70"), df.where("id >= 70"), rows_per_block=4, block_rows=16).collect()}
    for q in range(70, 90):
        near = np.lexsort((np.arange(70), np.sqrt(((pts[:70] - pts[q]) ** 2).sum(1))))[:5]
        assert abs(got[q] - lab[near].mean()) < 1e-12
