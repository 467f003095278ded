from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewheel.contract import CALENDAR_FEATURES, PRIOR_FEATURES
from tidewheel.functions.calendar import service_holidays
from tidewheel.operators import requests

GOOD = {"station_id": 7000, "date": "2023-07-19", "hour": 17}


def batch(spark, *bodies):
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    return requests.explode_requests(spark.createDataFrame(list(enumerate(texts)), "request_id int, body string"))


def judged(spark, *bodies):
    stations = spark.createDataFrame([(7000,), (7001,)], "station_id int")
    return requests.validate(batch(spark, *bodies).where("is_forecast"), stations)


@pytest.mark.parametrize("body, hours", [
    (GOOD, [17]),
    ([GOOD, {**GOOD, "hour": 8}], [17, 8]),
    ({"instances": [{**GOOD, "hour": 8}, GOOD]}, [8, 17]),
    ({"body": json.dumps(GOOD)}, [17]),
    ({"body": GOOD, "rawPath": "/forecast"}, [17]),
    ({"body": json.dumps({"instances": [GOOD]}), "requestContext": {"http": {"path": "/prod/forecast"}}}, [17]),
    ({"station_id": "7000", "date": "2023-07-19", "hour": "17"}, [17]),
])
def test_envelopes(spark, body, hours):
    ok = requests.accepted(judged(spark, body)).orderBy("position").collect()
    assert [r.hour for r in ok] == hours
    assert {(r.station_id, r.start_date) for r in ok} == {(7000, dt.date(2023, 7, 19))}


@pytest.mark.parametrize("body, error", [
    ({**GOOD, "station_id": 9999}, "unknown station_id: 9999"),
    ({**GOOD, "hour": 24}, "hour must be 0-23, got 24"),
    ({**GOOD, "hour": -1}, "hour must be 0-23, got -1"),
    ({**GOOD, "hour": "five"}, "bad field: hour"),
    ({**GOOD, "hour": "8.7"}, "bad field: hour"),
    ({**GOOD, "station_id": "7000.9"}, "bad field: station_id"),
    ({**GOOD, "hour": [8]}, "bad field: hour"),
    ({**GOOD, "hour": None}, "bad field: hour"),
    ({**GOOD, "date": "2023-02-30"}, "bad field: date"),
    ({**GOOD, "date": "19/07/2023"}, "bad field: date"),
    ({"date": "2023-07-19", "hour": 3}, "missing field: station_id"),
    ({"body": {"station_id": 7000, "hour": 3}, "rawPath": "/forecast"}, "missing field: date"),
    ([], "body must be a record or a non-empty list of records"),
    ({"instances": []}, "body must be a record or a non-empty list of records"),
    ("{oops", "body is not valid json"),
    ([GOOD, {**GOOD, "hour": 30}], "hour must be 0-23, got 30"),
])
def test_refusals(spark, body, error):
    report = judged(spark, body)
    assert [r.error for r in requests.rejected(report).collect()] == [error]
    assert requests.accepted(report).count() == 0


def test_first_broken_record_names_the_error(spark):
    report = judged(spark, [GOOD, {**GOOD, "hour": 30}, {**GOOD, "station_id": 1}], GOOD)
    assert [(r.request_id, r.error) for r in requests.rejected(report).collect()] == [(0, "hour must be 0-23, got 30")]
    assert [r.request_id for r in requests.accepted(report).collect()] == [1]


def test_routing(spark):
    routed = {r.request_id: r.is_forecast for r in batch(
        spark, GOOD, {"station_id": 1}, {"body": GOOD, "rawPath": "/predict"},
        {"body": {"x": 1}, "rawPath": "/forecast"}, []).collect()}
    assert routed == {0: True, 1: False, 2: False, 3: True, 4: True}


def lookups(spark):
    by_hour = spark.createDataFrame([("7000|17|4", 3.5)], "key string, value double")
    by_month = spark.createDataFrame([("7000|7", 1.25)], "key string, value double")
    return by_hour, by_month, F.lit(0.836)


def test_seventeen_features(spark):
    expanded = requests.expand(requests.accepted(judged(spark, GOOD)), service_holidays(spark), *lookups(spark)).first()
    assert (expanded.weekday, expanded.season, expanded.quarter, expanded.month, expanded.week_of_year) == (4, "summer", 3, 7, 29)
    assert (expanded.is_weekend, expanded.is_holiday, expanded.default_used) == (0, 0, False)
    assert (expanded.py_station_hour_weekday_mean, expanded.py_station_month_mean) == (3.5, 1.25)
    assert (expanded.hour_sin, expanded.hour_cos) == (-0.965926, -0.258819)


def test_missing_history_uses_and_reports_the_default(spark):
    asked = judged(spark, {**GOOD, "date": "2023-11-15"}, {**GOOD, "date": "2023-12-25", "hour": 0})
    got = requests.expand(requests.accepted(asked), service_holidays(spark), *lookups(spark)).orderBy("request_id").collect()
    assert [(r.py_station_month_mean, r.default_used) for r in got] == [(0.836, True), (0.836, True)]
    assert [(r.is_holiday, r.season, r.is_weekend) for r in got] == [(0, "fall", 0), (1, "winter", 0)]


def test_direct_features(spark):
    full = {name: 1 for name in CALENDAR_FEATURES + PRIOR_FEATURES}
    full["season"] = "winter"
    lacking = {k: v for k, v in full.items() if k not in ("season", "month_cos")}
    given = requests.given_features(batch(spark, full, lacking).where("not is_forecast")).orderBy("request_id").collect()
    assert given[0].error is None and given[0].season == "winter" and given[0].hour_sin == 1.0
    assert given[1].error == "missing features: season, month_cos"


def test_scores_are_clipped_and_rounded(spark):
    frame = spark.createDataFrame([(1, 0, -0.5), (2, 0, 4.971649)], "request_id int, position int, pred double")
    assert [r.prediction for r in requests.score(frame, lambda df: df).collect()] == [0.0, 4.9716]


def test_station_list(spark):
    pool = spark.createDataFrame([(2,), (1,), (3,)], "station_id int")
    names = spark.createDataFrame([(1, " Bay  St /\tKing "), (2, "Quay")], "dim_station_id int, dim_station_name string")
    got = requests.service_stations(pool, names, 2022).collect()
    assert [(r.station_id, r.station_name, r.target_year) for r in got] == [
        (1, "Bay St / King", 2023), (2, "Quay", 2023), (3, "3", 2023)]


def test_numbers_lose_their_fraction_and_texts_keep_it(spark):
    ok = requests.accepted(judged(spark, {**GOOD, "hour": 8.7, "station_id": " 7000 "})).collect()
    assert [(r.station_id, r.hour) for r in ok] == [(7000, 8)]


def test_direct_values_are_read_or_refused(spark):
    full = {n: 1 for n in CALENDAR_FEATURES + PRIOR_FEATURES} | {"season": "fall"}
    less = {n: v for n, v in full.items() if n != "month_cos"}
    bodies = [full, {**full, "hour": "abc"}, {**full, "month_sin": "xyz"}, [full, less], [less, less],
              {**full, "hour_sin": None}, {**full, "weekday": "2"}]
    given = requests.given_features(batch(spark, *[{"instances": b if isinstance(b, list) else [b]} for b in bodies]))
    got = {(r.request_id, r.position): (r.error, r.month_cos, r.hour_sin, r.weekday) for r in given.collect()}
    assert got == {(0, 0): (None, 1.0, 1.0, 1), (1, 0): ("bad field: hour", 1.0, 1.0, 1),
                   (2, 0): ("bad field: month_sin", 1.0, 1.0, 1), (3, 0): (None, 1.0, 1.0, 1), (3, 1): (None, None, 1.0, 1),
                   (4, 0): ("missing features: month_cos", None, 1.0, 1), (4, 1): ("missing features: month_cos", None, 1.0, 1),
                   (5, 0): (None, 1.0, None, 1), (6, 0): (None, 1.0, 1.0, 2)}
