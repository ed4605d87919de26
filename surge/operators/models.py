"""Model stage: Spark ML estimators matched to the reference's settings,
train-all-and-score, exact kNN by a broadcast ball tree, an RBF-kernel SVM approximation, and the
small-feature rebuild.

Conversions (SURVEY I6-I15):
* logistic, C = 1 (L2):   regParam = 1 / n_train, standardization off;
* ridge, alpha:           normal solver, regParam = alpha * stddev_pop(y) / n_train;
* lasso, alpha:           elasticNetParam = 1, regParam = alpha;
* forests / boosting:     depth and tree counts as in the reference; boosting uses
                          depth 3 and step 0.1 (the reference library's defaults).
Features are standardised with train-split mean and *population* std first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surge.operators.features import standardize
from surge.operators.metrics import classification_metrics, predicted_class, regression_metrics
from surge.plans.stage import materialize
from surge.session import delete_at_exit, scratch_path

SEED = 42
CLASSIFIERS = ("Logistic Regression", "Decision Tree", "Random Forest", "Gradient Boosting", "SVM", "KNN")
REGRESSORS = ("Ridge Regression", "Lasso Regression", "Random Forest Regressor", "Gradient Boosting Regressor")
DATASETS = {"train": "Train", "val": "Val", "test": "Test"}


def classifier(name: str, n_train: int):
    if name == "Logistic Regression":
        return LogisticRegression(maxIter=1000, regParam=1.0 / max(n_train, 1), elasticNetParam=0.0,
                                  standardization=False)
    if name == "Decision Tree":
        return DecisionTreeClassifier(maxDepth=10, seed=SEED)
    if name == "Random Forest":
        return RandomForestClassifier(numTrees=150, maxDepth=10, featureSubsetStrategy="sqrt",
                                      minInstancesPerNode=2, seed=SEED)
    if name == "Gradient Boosting":
        return GBTClassifier(maxIter=100, maxDepth=3, stepSize=0.1, seed=SEED)
    raise ValueError(name)


def regressor(name: str, n_train: int, y_std: float, alpha: float = 1.0):
    if name == "Ridge Regression":
        return LinearRegression(solver="normal", elasticNetParam=0.0, standardization=False,
                                regParam=alpha * y_std / max(n_train, 1))
    if name == "Lasso Regression":
        return LinearRegression(elasticNetParam=1.0, regParam=alpha, standardization=False, maxIter=1000)
    if name == "Random Forest Regressor":
        return RandomForestRegressor(numTrees=150, maxDepth=10, featureSubsetStrategy="all",
                                     minInstancesPerNode=2, seed=SEED)
    if name == "Gradient Boosting Regressor":
        return GBTRegressor(maxIter=100, maxDepth=3, stepSize=0.1, seed=SEED)
    raise ValueError(name)


def prepare(df: DataFrame, features: Sequence[str], *, split: str = "split") -> DataFrame:
    """Standardise with train statistics and assemble ``features`` into a vector."""
    z = standardize(df, list(features), fit_on=df.where(F.col(split) == "train"), suffix="__z")
    return VectorAssembler(inputCols=[f"{c}__z" for c in features], outputCol="features",
                           handleInvalid="keep").transform(z)


# ------------------------------------------------------------------ RBF SVM approximation

def rff_transform(df: DataFrame, *, dim: int, components: int = 200, gamma: float | None = None,
                  seed: int = SEED, input_col: str = "features", output_col: str = "rff") -> DataFrame:
    """Random Fourier features (Rahimi & Recht 2007) for the RBF kernel
    exp(-gamma |x - y|^2): z = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma).
    The projection is a vectorised pandas UDF over Arrow batches."""
    gamma = 1.0 / dim if gamma is None else gamma   # standardised inputs: variance 1
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(components, dim))
    b = rng.uniform(0.0, 2.0 * math.pi, size=components)
    scale = math.sqrt(2.0 / components)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def project(xs: pd.Series) -> pd.Series:
        x = np.vstack(xs.to_numpy()) if len(xs) else np.zeros((0, dim))
        z = scale * np.cos(x @ w.T + b)
        return pd.Series(list(z))

    from pyspark.ml.functions import array_to_vector
    return df.withColumn(output_col, array_to_vector(project(vector_to_array(F.col(input_col)))))


class PlattSVM:
    """LinearSVC on random Fourier features, then a one-feature logistic fit of
    the margin (Platt scaling) for probabilities."""

    def __init__(self, dim: int, n_train: int, components: int = 200):
        self.dim, self.components, self.n = dim, components, n_train

    def fit(self, train: DataFrame) -> PlattSVM:
        t = rff_transform(train, dim=self.dim, components=self.components)
        self.svc = LinearSVC(featuresCol="rff", maxIter=200, standardization=False,
                             regParam=1.0 / max(self.n, 1)).fit(t)
        margin = self._margin(self.svc.transform(t))
        self.platt = LogisticRegression(featuresCol="_m", maxIter=100, regParam=0.0).fit(margin)
        return self

    @staticmethod
    def _margin(df: DataFrame) -> DataFrame:
        m = vector_to_array(F.col("rawPrediction"))[1]
        return VectorAssembler(inputCols=["_mv"], outputCol="_m").transform(
            df.drop("prediction").withColumn("_mv", m).drop("rawPrediction"))

    def transform(self, df: DataFrame) -> DataFrame:
        t = self.svc.transform(rff_transform(df, dim=self.dim, components=self.components))
        out = self.platt.transform(self._margin(t))
        return out.withColumnRenamed("_mv", "margin").drop("rff", "_m")


# ------------------------------------------------------------------ train all and score

def _score_col(pred: DataFrame) -> DataFrame:
    return pred.withColumn("score", vector_to_array(F.col("probability"))[1])


def train_classifiers(prepared: DataFrame, *, label: str = "High_Risk", split: str = "split",
                      names: Sequence[str] = CLASSIFIERS, dim: int | None = None) -> DataFrame:
    """Fit each classifier on the train split, score every split; one metrics
    table (model, dataset, Accuracy, AUROC, Recall, Precision, F1-Score)."""
    data = prepared.withColumn("label", F.col(label).cast("double")).where(F.col(split).isNotNull())
    # a checkpointed training table: iterative fits re-read it many times and
    # must not re-run (or re-plan) the feature pipeline on every pass
    data = materialize(data.select("features", "label", split))
    train = data.where(F.col(split) == "train")
    n = train.count()
    scored = None
    for name in names:
        given = [F.col(split), F.col("label").cast("int").alias("label")]
        if name == "KNN":
            rows = data.select(F.monotonically_increasing_id().alias("id"), vector_to_array("features").alias("features"), "label", split)
            rows = materialize(rows)
            votes = knn_predict(rows.where(F.col(split) == "train"), rows, k=5)
            s = rows.join(votes, "id").select(F.lit(name).alias("model"), *given, F.col("probability").alias("score"),
                                              predicted_class(F.col("probability")).alias("predicted"))
        elif name == "SVM":
            # the class is the side of the margin; the Platt probability only ranks
            pred = _score_col(PlattSVM(dim or len(prepared.select("features").first()[0]), n).fit(train).transform(data))
            s = pred.select(F.lit(name).alias("model"), *given, "score", (F.col("margin") > 0).cast("int").alias("predicted"))
        else:
            s = _score_col(classifier(name, n).fit(train).transform(data)).select(F.lit(name).alias("model"), *given, "score",
                                                                                  predicted_class(F.col("score")).alias("predicted"))
        scored = s if scored is None else scored.unionByName(s)
    ds = F.create_map(*[F.lit(x) for kv in DATASETS.items() for x in kv])
    # every model scores once: the metrics read the written scores
    return classification_metrics(materialize(scored.withColumn("dataset", ds[F.col(split)])), predicted="predicted")


def train_regressors(prepared: DataFrame, *, target: str = "Total_Hospitalization", split: str = "split",
                     names: Sequence[str] = REGRESSORS, alpha: float = 1.0) -> DataFrame:
    """Fit each regressor on the train split; (model, dataset, RMSE, MAE, R2, MAPE)."""
    data = prepared.withColumn("label", F.col(target).cast("double")).where(F.col(split).isNotNull())
    data = materialize(data.select("features", "label", split))
    train = data.where(F.col(split) == "train")
    stats = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("s")).first()
    scored = None
    for name in names:
        model = regressor(name, stats["n"], stats["s"] or 0.0, alpha).fit(train)
        s = model.transform(data).select(F.lit(name).alias("model"), F.col(split), F.col("label").alias("y"),
                                         F.col("prediction").alias("yhat"))
        scored = s if scored is None else scored.unionByName(s)
    ds = F.create_map(*[F.lit(x) for kv in DATASETS.items() for x in kv])
    return regression_metrics(materialize(scored.withColumn("dataset", ds[F.col(split)])))


# ------------------------------------------------------------------ exact k nearest neighbours

#: Balls in a run that one matrix product covers, pairs measured at once, asked rows of a task and of a step.
BALLS, PAIRS, TASK_ROWS, STEP_ROWS = 32, 1 << 15, 4096, 1024


def no_neighbours(n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distance, id, label) of the k nearest points of n rows that have met none yet."""
    return np.full((n, k), np.inf), np.full((n, k), np.iinfo(np.int64).max), np.zeros((n, k))


def vote(dist: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(votes, neighbours): mean label and number of the nearest points."""
    have = np.isfinite(dist)
    count = have.sum(1)
    return np.where(have, label, 0).sum(1) / np.maximum(count, 1), count


class BallTree:
    """Balls over labelled points for exact nearest neighbours: leaves of at most ``leaf`` rows, halved along their widest dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, y: np.ndarray, leaf: int):
        whole = np.isfinite(x).all(axis=1)  # a point with a missing component is nobody's neighbour
        ids, x, y = ids[whole], x[whole], y[whole]
        order, done, todo = [], [], [np.arange(len(x))] if len(x) else []
        while todo:
            rows = todo.pop()
            if len(rows) <= leaf:
                order.append(rows)
                done.append(len(rows))
                continue
            wide = x[rows]
            axis = int((wide.max(0) - wide.min(0)).argmax())
            split = np.argsort(wide[:, axis], kind="stable")
            todo += [rows[split[:len(rows) // 2]], rows[split[len(rows) // 2:]]]
        at = np.concatenate(order) if order else np.zeros(0, np.int64)
        self.ids, self.x, self.y = ids[at], x[at], y[at]
        self.upto = np.concatenate([[0], np.cumsum(done)]).astype(np.int64)
        self.norm = (self.x * self.x).sum(1)
        balls = list(zip(self.upto[:-1], self.upto[1:], strict=True))
        self.middle = np.array([self.x[i:j].mean(0) for i, j in balls]).reshape(len(balls), x.shape[1])
        self.radius = np.array([np.sqrt(((self.x[i:j] - m) ** 2).sum(1)).max() for (i, j), m in zip(balls, self.middle, strict=True)])

    def nearest(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(votes, neighbours): mean label and number of the k nearest points of each row of q (ties by smaller id).

        Runs of ``BALLS`` balls are visited by their least possible distance; one that cannot hold a nearer point is never opened.
        In an open run a matrix product tells which points may be near enough; only those are measured, by direct differences."""
        dist, ident, label = no_neighbours(len(q), k)
        self.improve(q, dist, ident, label)
        return vote(dist, label)

    def improve(self, q: np.ndarray, dist: np.ndarray, ident: np.ndarray, label: np.ndarray) -> None:
        """Merge the points of this tree into the nearest ones that the rows of q have so far, in place."""
        n, k = dist.shape
        if n and len(self.x):
            own = (q * q).sum(1)
            away = np.sqrt(np.maximum(own[:, None] + (self.middle ** 2).sum(1)[None] - 2 * q @ self.middle.T, 0))
            scale = 1e-6 * (1 + np.abs(q[np.isfinite(q)]).max(initial=0) + np.abs(self.middle).max())  # rounding of the expansion above
            first = np.arange(0, self.middle.shape[0], BALLS)
            bound = np.minimum.reduceat(away - self.radius[None] - scale, first, axis=1)
            upto = self.upto[np.append(first, len(self.upto) - 1)]
            turn = np.argsort(bound, axis=1)
            for r in range(turn.shape[1]):
                run = turn[:, r]
                open_ = np.flatnonzero(bound[np.arange(n), run] <= dist[:, -1])
                if not len(open_):
                    break
                for b in np.unique(run[open_]).tolist():
                    rows = open_[run[open_] == b]
                    i, j = upto[b], upto[b + 1]
                    who, point = self._candidates(q[rows], own[rows], dist[rows, -1], i, j, k)
                    begin, done = np.searchsorted(who, np.arange(len(rows) + 1)), 0
                    while done < len(rows):  # so many pairs at once as fit in memory, whole rows of q
                        upper = max(done + 1, int(np.searchsorted(begin, begin[done] + PAIRS, side="right")) - 1)
                        at = slice(begin[done], begin[upper])
                        self._keep_best(q, rows[done:upper], who[at] - done, i + point[at], dist, ident, label)
                        done = upper

    def _candidates(self, q: np.ndarray, own: np.ndarray, far: np.ndarray, i: int, j: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of q, point of i .. j): every pair that may be as near as ``far``, or among the row's k nearest points of i .. j."""
        slack = 4e-15 * (q.shape[1] + 16)  # above the rounding of the expansion, as a share of both squared lengths
        near = self.norm[i:j] * (1 - slack) - 2 * (q @ self.x[i:j].T)
        reach = far ** 2 - own * (1 - slack)
        new = np.flatnonzero(np.isinf(far))
        if len(new) and j - i >= k:
            least = np.partition(near[new], k - 1, axis=1)[:, k - 1] + 4 * slack * (own[new] + self.norm[i:j].max())
            reach[new] = np.where(np.isnan(least), np.inf, least)
        return np.nonzero(near <= reach[:, None])

    def _keep_best(self, q: np.ndarray, rows: np.ndarray, who: np.ndarray, point: np.ndarray, dist: np.ndarray, ident: np.ndarray,
                   label: np.ndarray) -> None:
        """Merge the pairs (rows[who], point) into the k nearest of ``rows``, in place."""
        k = dist.shape[1]
        diff = q[rows[who]] - self.x[point]  # direct differences keep near-ties exact
        of = np.concatenate([np.repeat(np.arange(len(rows)), k), who])
        d = np.concatenate([dist[rows].ravel(), np.sqrt((diff * diff).sum(axis=1))])
        t = np.concatenate([ident[rows].ravel(), self.ids[point]])
        y = np.concatenate([label[rows].ravel(), self.y[point]])
        order = np.lexsort((t, d, of))
        head = np.searchsorted(of[order], np.arange(len(rows)))
        best = order[head[:, None] + np.arange(k)]
        dist[rows], ident[rows], label[rows] = d[best], t[best], y[best]


def labelled_blocks(kept: DataFrame, block_rows: int) -> list[DataFrame]:
    """``kept`` dealt into blocks of some ``block_rows`` rows, written to the shared folder; as it is if it is one block."""
    blocks = -(-kept.count() // block_rows)
    if blocks <= 1:
        return [kept]
    spark = kept.sparkSession
    path = scratch_path(spark, "knn-blocks")
    kept.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks))).repartition(blocks, "block").write.partitionBy("block").parquet(path)
    delete_at_exit(spark, path)
    return [spark.read.schema(kept.schema).parquet(f"{path}/block={b}") for b in range(blocks)]


def knn_predict(train: DataFrame, test: DataFrame, *, k: int = 5, id_col: str = "id", features: str = "features",
                label: str = "label", rows_per_block: int = 128, block_rows: int = 50_000) -> DataFrame:
    """Exact kNN vote share (probability of class 1) for every test row, among all labelled rows.

    The labelled rows are dealt into blocks of some ``block_rows``; one block's ball tree (balls of ``rows_per_block`` rows) at a time is
    made and broadcast, and the asked rows carry their k nearest so far from block to block.  Test rows are dealt out
    ``TASK_ROWS`` a task and scored there: no pairs beyond the balls that can hold a neighbour.  Distances are exact in float64,
    ties go to the smaller id; rows without features, label or id are left out."""
    kept = train.select(F.col(id_col).cast("long").alias("i"), F.col(features).alias("x"), F.col(label).cast("double").alias("y")).dropna()
    blocks = labelled_blocks(kept, block_rows)
    best = ["dist", "ident", "label"]

    def shared_tree(block: DataFrame) -> Broadcast:
        rows = block.toArrow()
        x = np.array(rows.column("x").to_pylist(), dtype=np.float64).reshape(rows.num_rows, -1)
        tree = BallTree(rows.column("i").to_numpy(), x, rows.column("y").to_numpy(), rows_per_block)
        return train.sparkSession.sparkContext.broadcast(tree)

    def scorer(shared: Broadcast, first: bool, last: bool):
        def score(batches):
            for batch in batches:
                q = np.vstack(batch["x"].to_numpy()).astype(np.float64) if len(batch) else np.zeros((0, shared.value.x.shape[1]))
                found = no_neighbours(len(q), k) if first or not len(q) else tuple(np.vstack(batch[c].to_numpy()) for c in best)
                for a in range(0, len(q), STEP_ROWS):
                    shared.value.improve(q[a:a + STEP_ROWS], *[f[a:a + STEP_ROWS] for f in found])
                if last:
                    votes, count = vote(found[0], found[2])
                    yield pd.DataFrame({id_col: batch["i"], "probability": votes, "n_neighbours": count.astype(np.int64)})
                else:
                    yield pd.DataFrame({"i": batch["i"], "x": batch["x"]} | {c: list(f) for c, f in zip(best, found, strict=True)})
        return score

    asked = test.select(F.col(id_col).cast("long").alias("i"), F.col(features).alias("x")).dropna()
    # However few files and row groups hold the asked rows, their number decides how many tasks score them.
    asked = asked.repartition(1 + asked.count() // TASK_ROWS, "i")
    so_far = f"i long, x {asked.schema['x'].dataType.simpleString()}, dist array<double>, ident array<long>, label array<double>"
    for at, block in enumerate(blocks[:-1]):
        shared = shared_tree(block)
        asked = materialize(asked.mapInPandas(scorer(shared, at == 0, False), so_far))
        shared.destroy()
    return asked.mapInPandas(scorer(shared_tree(blocks[-1]), len(blocks) == 1, True),
                             f"`{id_col}` long, probability double, n_neighbours long").where("n_neighbours > 0")


def fit_one(prepared: DataFrame, *, kind: str, name: str, label: str, split: str = "split"):
    """Fit one named classifier / regressor on the train split of a prepared table."""
    train = materialize(prepared.where(F.col(split) == "train")
                        .select("features", F.col(label).cast("double").alias("label")))
    stats = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("s")).first()
    est = classifier(name, stats["n"]) if kind == "classifier" else regressor(name, stats["n"], stats["s"] or 0.0)
    return est.fit(train)


def score_requests(features: DataFrame, classifier_model, regressor_model, *, threshold: float = 0.5) -> DataFrame:
    """Probability of the high-risk class, predicted class and a non-negative count."""
    made = ["features", "rawPrediction", "probability", "prediction"]
    c = classifier_model.transform(features).withColumn("high_risk_probability",
                                                        vector_to_array(F.col("probability"))[1])
    scaled = [x for x in c.columns if x.endswith("__z") and x not in features.columns]
    c = c.withColumn("risk_pred", (F.col("high_risk_probability") > threshold).cast("int"))
    c = c.drop(*[x for x in made if x not in features.columns], "prediction", *scaled)
    r = regressor_model.transform(c)
    return r.withColumn("predicted_count", F.greatest(F.col("prediction"), F.lit(0.0))).drop("prediction", *scaled)


# ------------------------------------------------------------------ fitted pipelines

def scaler_stage(train: DataFrame, features: Sequence[str]) -> SQLTransformer:
    """The standardisation of ``features`` by train mean and population std as a fitted, writable stage (columns ``c__z``).

    A missing feature counts as 0, a constant one is divided by 1: as ``feature_matrix`` and ``standardize`` do."""
    x = {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in features}
    got = train.agg(*[F.avg(x[c]).alias(f"m{i}") for i, c in enumerate(features)],
                    *[F.stddev_pop(x[c]).alias(f"s{i}") for i, c in enumerate(features)]).first()
    said = [f"(coalesce(double(`{c}`), 0D) - ({got[f'm{i}'] or 0.0!r}D)) / {got[f's{i}'] or 1.0!r}D AS `{c}__z`" for i, c in enumerate(features)]
    return SQLTransformer(statement=f"SELECT *, {', '.join(said)} FROM __THIS__")


def fit_pipeline(rows: DataFrame, features: Sequence[str], *, kind: str, name: str, label: str, split: str = "split") -> PipelineModel:
    """Scaler, assembler and one named model, fitted on the train rows of a raw feature table; it scores raw feature rows."""
    train = materialize(rows.where(F.col(split) == "train").select(*[F.col(f"`{c}`") for c in features], F.col(label).cast("double").alias("label")))
    before = [scaler_stage(train, features), VectorAssembler(inputCols=[f"{c}__z" for c in features], outputCol="features", handleInvalid="keep")]
    stats = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("s")).first()
    est = classifier(name, stats["n"]) if kind == "classifier" else regressor(name, stats["n"], stats["s"] or 0.0)
    ready = materialize(PipelineModel(before).transform(train).select("features", "label"))
    return PipelineModel([*before, est.fit(ready)])
