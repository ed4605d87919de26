import datetime as dt

from surge.operators.scoring import score_fallback, validate_requests
from surge.sources.stations import station_fallback, station_year_coverage


def test_station_fallback_takes_first_station_with_rows(spark):
    cat = spark.createDataFrame([("bronx", 1, "A"), ("bronx", 2, "B"), ("queens", 1, "C"), ("kings", 1, "Z")],
                                "borough string, priority int, station_id string")
    landed = spark.createDataFrame([("B", dt.date(2020, 1, 1), 2020), ("C", dt.date(2020, 1, 2), 2020),
                                    ("C", dt.date(2021, 1, 2), 2021)], "STATION string, DATE date, year int")
    got = {r.borough: r.station_id for r in station_fallback(landed, cat).collect()}
    assert got == {"bronx": "B", "queens": "C"}
    cov = {(r.STATION, r.year): r.n_rows for r in station_year_coverage(landed, cat).collect()}
    assert cov == {("B", 2020): 1, ("C", 2020): 1, ("C", 2021): 1}


def test_validate_requests_errors_and_default_capacity(spark):
    req = spark.createDataFrame([(1, " Queens ", "2024-01-05", None), (2, "atlantis", "2024-01-05", 10),
                                 (3, "queens", "05/01/2024", 10), (4, None, "2024-01-05", 10)],
                                "request_id long, borough string, date string, capacity int")
    got = {r.request_id: (r.borough, r.req_date, r.capacity, r.status, r.error)
           for r in validate_requests(req, valid_keys=["queens"]).collect()}
    assert got[1] == ("queens", dt.date(2024, 1, 5), 80, "ok", None)
    assert got[2][3:] == ("error", "unknown key")
    assert got[3][3:] == ("error", "bad date")
    assert got[4][3:] == ("error", "missing field")


def test_fallback_treats_zero_history_as_missing(spark):
    df = spark.createDataFrame([(1, "bronx", 0.0), (2, "queens", 60.0), (3, "elsewhere", None)],
                               "request_id int, borough string, historical_average double")
    got = {r.request_id: (r.expected_admissions, r.risk_level, r.risk_probability, r.confidence)
           for r in score_fallback(df).collect()}
    assert got[1] == (85.0, "Moderate", 0.45, "Low (Baseline)")
    assert got[2] == (60.0, "Moderate", 0.6, "Medium (Historical Data)")
    assert got[3] == (60.0, "Moderate", 0.45, "Low (Baseline)")
