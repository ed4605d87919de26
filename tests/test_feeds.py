import datetime as dt
import os
import tempfile

import pytest

from surge.sources import feeds


def land(lines, name="a.csv"):
    path = tempfile.mkdtemp(prefix="surge-feed-")
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_visits_with_mixed_dates_and_rejects(spark):
    path = land(['Metric,Dim1Value,Count,"Note, long",Date',
                 'ED, Bronx ,12,"a, ""b""",2024-01-05',
                 "ED,QUEENS,abc,,1/6/2024",
                 "ED,Queens,1,,01/07/2024 12:30:00 PM",
                 "ED,Queens,2,,2024-01-08T10:00:00",
                 "ED,Queens,3,,2024/01/09",
                 "ED,Queens,4,,10 Jan 2024",
                 "ED,Queens,5,,13/13/2024",
                 "ED,,6,,2024-01-05",
                 "ED,Queens,7,,",
                 "ED,Queens"])
    df = feeds.read_feed(spark, path, feeds.VISITS)
    good = sorted((r["Date"], r["Dim1Value"], r["Count"]) for r in feeds.accepted(df).collect())
    assert good == [(dt.date(2024, 1, 5), "bronx", "12"), (dt.date(2024, 1, 6), "queens", "abc"), (dt.date(2024, 1, 7), "queens", "1"),
                    (dt.date(2024, 1, 8), "queens", "2"), (dt.date(2024, 1, 9), "queens", "3"), (dt.date(2024, 1, 10), "queens", "4")]
    assert {r["issue"]: r["n_rows"] for r in feeds.reject_counts(df).collect()} == {"bad date": 1, "no key": 1, "no date": 1, "broken line": 1}
    assert feeds.accepted(df).columns == ["Date", "Dim1Value", "Count"]
    assert feeds.rejected(df).where("_reject = 'bad date'").first()["_rescued"] == {"Date": "13/13/2024"}


def test_typed_values_are_rescued(spark):
    path = land(["DATE,borough,TMAX,TMIN,year,extra", "2024-01-05,Bronx,3.5,T,2024,x", "2024-01-06,Bronx,,-1,20x4,x"])
    df = feeds.read_feed(spark, path, feeds.WEATHER)
    rows = {r["DATE"].day: r for r in df.collect()}
    assert (rows[5]["TMAX"], rows[5]["TMIN"], rows[5]["year"], rows[5]["_rescued"]) == (3.5, None, 2024, {"TMIN": "T"})
    assert (rows[6]["TMAX"], rows[6]["TMIN"], rows[6]["year"], rows[6]["_rescued"]) == (None, -1.0, None, {"year": "20x4"})
    assert feeds.accepted(df).count() == 2
    assert {r["issue"]: r["n_rows"] for r in feeds.reject_counts(df).collect()} == {"rescued TMIN": 1, "rescued year": 1}
    assert dict(df.dtypes)["year"] == "int" and "extra" not in df.columns


def test_missing_columns(spark):
    path = land(["Date,Dim1Value", "2024-01-05,Bronx"])
    with pytest.raises(ValueError, match="Count"):
        feeds.read_feed(spark, path, feeds.VISITS)
    assert feeds.read_feed(spark, path, feeds.VISITS, strict=False).columns == ["Date", "Dim1Value", "_rescued", "_reject"]
    no_key = land(["Date,Count", "2024-01-05,1"])
    assert [r["_reject"] for r in feeds.read_feed(spark, no_key, feeds.VISITS, strict=False).collect()] == ["no key"]


def test_empty_feed_and_round_trip(spark):
    empty = feeds.read_feed(spark, land(["Date,Dim1Value,Count"]), feeds.VISITS)
    assert empty.count() == 0 and feeds.reject_counts(empty).count() == 0
    rows = spark.createDataFrame([("2024-01-05", 'the "Bronx", NY', "1\n2")], "Date string, Dim1Value string, Count string")
    path = os.path.join(tempfile.mkdtemp(prefix="surge-feed-"), "f")
    feeds.write_feed(rows, path)
    got = feeds.read_feed(spark, path, feeds.VISITS).first()
    assert got["Dim1Value"] == 'the "bronx", ny' and got["_reject"] is None or got["_reject"] == "broken line"


def test_guarded_formats_give_the_dates_of_plain_parsing(spark):
    from pyspark.sql import functions as F
    from surge.functions.columns import DATE_FORMATS, DATE_SHAPES, parse_date, parse_dates
    assert set(DATE_FORMATS) <= set(DATE_SHAPES)
    texts = ["1997-03-05", " 1997-03-05 ", "1997-3-5", "1997-13-05", "+12345-01-01", "-1997-01-01", "1997-03-05T10:11:12", "1997-03-05t10:11:12",
             "1997-03-05 10:11:12", "1997-03-05 10:11:12.5", "1997-03-05 10:11", "1997-03-05Z", "1997/03/05", "1997/3/5", "3/5/1997", "03/05/1997",
             "00003/0005/1997", "3/5/97", "13/5/1997", "2/30/1997", "3/5/+12345", "3/5/1997 1:02:03 AM", "03/05/1997 01:02:03 pm", "3/5/1997 13:02:03 PM",
             "3/5/1997 1:02:03", "3/5/1997 1:02:03 xx", "5 Mar 1997", "05 mar 1997", "5 March 1997", "5  Mar 1997", "pending", "", " ", "1997", "1997-03",
             "1997-03-05\n", "\u0661997-03-05", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    s = F.trim(F.col("t"))
    plain = F.coalesce(*[F.try_to_timestamp(s, F.lit(f)).cast("date") for f in DATE_FORMATS], parse_date(s))
    rows = df.select("t", parse_dates("t").cast("string").alias("got"), plain.cast("string").alias("want")).collect()
    assert [(r.t, r.got) for r in rows] == [(r.t, r.want) for r in rows]
    assert sum(r.got is not None for r in rows) > 12


def test_each_cell_is_parsed_once(spark):
    raw = spark.createDataFrame([("3/5/1997", "x", "1")], "Date string, Dim1Value string, Count string")
    plan = feeds.typed_rows(raw, feeds.VISITS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("M/d/yyyy h:mm:ss a") == 1
