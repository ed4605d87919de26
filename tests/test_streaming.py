import datetime as dt
import json
import os
import tempfile

from surge.streaming.requests import REQUEST_SCHEMA, commit_batch, committed, read_answers, score_batch, start_request_stream


def test_request_stream_scores_files(spark):
    base = tempfile.mkdtemp(prefix="surge-stream-")
    inbox = os.path.join(base, "in")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "a.json"), "w") as f:
        for r in [{"request_id": 1, "borough": "Queens", "date": "2024-02-02", "capacity": 10},
                  {"request_id": 2, "borough": "nowhere", "date": "2024-02-02", "capacity": 10}]:
            f.write(json.dumps(r) + "\n")
    hist = spark.createDataFrame([("queens", dt.date(2021, 2, 2), 40.0), ("queens", dt.date(2022, 2, 2), 60.0)],
                                 "borough string, Date date, Total_Hospitalization double")
    q = start_request_stream(spark, inbox, hist, os.path.join(base, "out"), os.path.join(base, "ckpt"),
                             valid_keys=["queens"])
    q.awaitTermination(120)
    out = {r["request_id"]: r for r in read_answers(spark, os.path.join(base, "out")).collect()}
    assert len(out) == 2 and out[1]["success"] and out[1]["error"] is None
    assert out[1]["historical_average"] == 50.0 and out[1]["risk_level"] == "Low" and out[1]["display_key"] == "Queens"
    assert not out[2]["success"] and out[2]["error"] == "unknown key" and out[2]["expected_admissions"] is None
    assert (out[2]["borough"], out[2]["capacity"]) == ("nowhere", 10)


def test_replayed_batch_is_answered_once(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="surge-stream-"), "out")
    hist = spark.createDataFrame([("queens", dt.date(2021, 2, 2), 40.0)], "borough string, Date date, Total_Hospitalization double")
    first = spark.createDataFrame([(1, "queens", "2024-02-02", 10), (2, None, "2024-02-02", None), (3, "queens", "02/02/2024", 5)], REQUEST_SCHEMA)
    rows = score_batch(first, hist, valid_keys=["queens"])
    # an attempt that died before its marker leaves rows that nobody reads and the next attempt replaces
    rows.limit(1).write.parquet(f"{out}/batches/batch=0")
    assert not committed(spark, out, 0)
    assert commit_batch(rows, out, 0) and not commit_batch(rows.limit(0), out, 0)
    assert commit_batch(rows.where("request_id = 1"), out, 1)
    rows.write.parquet(f"{out}/batches/batch=2")
    got = read_answers(spark, out)
    assert sorted((r["batch"], r["request_id"], r["success"], r["error"]) for r in got.collect()) == [
        (0, 1, True, None), (0, 2, False, "missing field"), (0, 3, False, "bad date"), (1, 1, True, None)]


def test_every_request_of_a_batch_is_answered(spark):
    reqs = spark.createDataFrame([(i, ["queens", "x", None][i % 3], "2024-02-02", i) for i in range(30)] * 2, REQUEST_SCHEMA)
    hist = spark.createDataFrame([], "borough string, Date date, Total_Hospitalization double")
    out = score_batch(reqs, hist, valid_keys=["queens"])
    assert out.count() == 60 and out.where("success").count() == 20 and out.where("error IS NULL").count() == 20
    assert score_batch(reqs.limit(0), hist, valid_keys=["queens"]).count() == 0
