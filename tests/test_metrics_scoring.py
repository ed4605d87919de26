import datetime as dt

from surge.operators.metrics import auroc, classification_metrics, confusion_matrix, regression_metrics
from surge.operators.scoring import historical_average, nearest_date_join


def test_auroc_with_ties(spark):
    df = spark.createDataFrame([("m", "Test", 0, 0.1), ("m", "Test", 0, 0.4), ("m", "Test", 1, 0.4),
                                ("m", "Test", 1, 0.8)], "model string, dataset string, label int, score double")
    assert auroc(df).first()["AUROC"] == 0.875


def test_confusion_grid_complete_and_undefined_precision(spark):
    df = spark.createDataFrame([("m", "Test", 0, 0.1), ("m", "Test", 0, 0.2)],
                               "model string, dataset string, label int, score double")
    grid = {(r.actual, r.predicted): r["count"] for r in confusion_matrix(df).collect()}
    assert grid == {(0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 0}
    m = classification_metrics(df).first()
    assert m["Precision"] == 0.0 and m["Recall"] == 0.0 and m["F1-Score"] == 0.0 and m["Accuracy"] == 1.0


def test_regression_metrics(spark):
    df = spark.createDataFrame([("m", "Test", 2.0, 1.0), ("m", "Test", 4.0, 5.0), ("m", "Test", 0.0, 1.0)],
                               "model string, dataset string, y double, yhat double")
    r = regression_metrics(df).first()
    assert abs(r.MAE - 1.0) < 1e-12 and abs(r.RMSE - 1.0) < 1e-12
    assert abs(r.R2 - (1 - 3 / 8)) < 1e-12 and abs(r.MAPE - 37.5) < 1e-9


def test_nearest_tie_goes_to_earlier_day(spark):
    hist = spark.createDataFrame([("q", dt.date(2020, 1, 1)), ("q", dt.date(2020, 1, 3)), ("q", dt.date(2020, 3, 1))],
                                 "borough string, Date date")
    req = spark.createDataFrame([(1, "q", dt.date(2020, 1, 2)), (2, "q", dt.date(2020, 2, 20)),
                                 (3, "z", dt.date(2020, 1, 2)), (4, "q", dt.date(2021, 1, 1))],
                                "request_id int, borough string, req_date date")
    got = {r.request_id: r.matched_date for r in nearest_date_join(req, hist).collect()}
    assert got == {1: dt.date(2020, 1, 1), 2: dt.date(2020, 3, 1), 3: None, 4: dt.date(2020, 3, 1)}


def test_nearest_keeps_the_count_of_repeated_request_ids(spark):
    hist = spark.createDataFrame([("q", dt.date(2020, 1, 1))], "borough string, Date date")
    req = spark.createDataFrame([(1, "q", dt.date(2020, 1, 2)), (1, "q", dt.date(2020, 1, 2)), (1, "q", dt.date(2020, 1, 4)),
                                 (2, None, dt.date(2020, 1, 2)), (3, "q", None)],
                                "request_id int, borough string, req_date date")
    got = sorted((r.request_id, r.day_gap) for r in nearest_date_join(req, hist).fillna(-1, ["day_gap"]).collect())
    assert got == [(1, 1), (1, 1), (1, 3), (2, -1), (3, -1)]


def test_historical_average_month_fallback(spark):
    hist = spark.createDataFrame([("q", dt.date(2021, 2, 1), 10.0), ("q", dt.date(2021, 2, 2), 21.0),
                                  ("q", dt.date(2023, 2, 2), 30.0)],
                                 "borough string, Date date, Total_Hospitalization double")
    req = spark.createDataFrame([(1, "q", dt.date(2024, 2, 29)), (2, "q", dt.date(2024, 2, 2)),
                                 (3, "q", dt.date(2024, 3, 1))], "request_id int, borough string, req_date date")
    got = {r.request_id: r.historical_average for r in historical_average(req, hist).collect()}
    assert got == {1: 20.33, 2: 25.5, 3: None}


def test_each_asked_day_is_scored_once(spark, monkeypatch):
    from pyspark.sql import functions as F
    from surge.plans import catalog as cat
    hist = spark.createDataFrame([("a", "1997-01-01", 1.0), ("a", "1997-01-09", 2.0)], "borough string, d string, f double") \
        .select("borough", F.to_date("d").alias("Date"), "f")
    asked = [("a", "1997-01-02"), ("a", "1997-01-09"), ("b", "1997-01-01")]
    req = spark.createDataFrame([(i, *asked[i % 3], 20 + i % 2, "ok", None) for i in range(60)] + [(60, "a", None, 20, "error", "bad date")],
                                "request_id long, borough string, d string, capacity int, status string, error string") \
        .withColumn("req_date", F.to_date("d")).drop("d")
    seen = []

    def score(rows, *models):
        seen.append(rows.count())
        return rows.withColumns({"predicted_count": F.coalesce("f", F.lit(0.0)) * 15, "high_risk_probability": F.lit(0.5), "risk_pred": F.lit(1)})

    names = ["Random Forest", "Random Forest Regressor", "Gradient Boosting", "Gradient Boosting Regressor"]
    monkeypatch.setattr(cat, "bundle", lambda *_: (dict.fromkeys(names), ["f"], hist, {}))
    monkeypatch.setattr(cat, "validated", lambda *_: req)
    monkeypatch.setattr(cat.mdl, "score_requests", score)
    near = {r.request_id: r for r in cat.q_score_nearest(spark, "").collect()}
    cascade = {r.request_id: r for r in cat.q_score_cascade(spark, "").collect()}
    assert seen == [3, 3] and len(near) == len(cascade) == 61
    assert [near[i].predicted_count for i in range(3)] == [15.0, 30.0, 0.0] and near[0].day_gap == 1 and near[2].matched_date is None
    assert (near[4].additional_beds_needed, near[1].additional_beds_needed) == (10, 9)
    assert [cascade[i].match_level for i in range(3)] == ["month", "exact", "none"] and cascade[60].error == "bad date"
