from __future__ import annotations

import pytest

from tidewheel.contract import STAGE_SCHEMA
from tidewheel.operators import cleaning, quality

BASE = dict(trip_id="1", trip_duration="730", start_time="01/05/2019 08:10", start_station_id="7000",
            start_station_name="A St", end_time="01/05/2019 08:22", end_station_id="7001", end_station_name="B St",
            bike_id="12", user_type="Annual Member", model="ICONIC", source_year="2019")


def stage(spark, *changes):
    return spark.createDataFrame([tuple({**BASE, **c}[f] for f in STAGE_SCHEMA.names) for c in changes], STAGE_SCHEMA)


@pytest.mark.parametrize("change", [
    {"trip_duration": "0"}, {"trip_duration": "-5"}, {"trip_duration": "abc"}, {"trip_duration": None},
    {"trip_duration": "1e3"}, {"start_time": "13/45/2019 10:00"}, {"start_time": "2019-01-05 08:10"},
    {"start_time": "1/5/2019 8:10"}, {"start_time": None}, {"end_station_id": None}, {"start_station_id": "X1"},
    {"trip_id": ""}, {"trip_id": "12a"},
])
def test_broken_keys_drop_the_row(spark, change):
    assert cleaning.clean(stage(spark, change)).count() == 0


@pytest.mark.parametrize("column, largest", [
    ("trip_id", 2 ** 63 - 1), ("start_station_id", 2 ** 31 - 1), ("end_station_id", 2 ** 31 - 1)])
def test_numbers_beyond_the_type_drop_the_row(spark, column, largest):
    kept = [str(largest), f"000{largest}", "0", "000", "0" * 40 + "7"]
    gone = [str(largest + 1), f"00{largest + 1}", "9" * len(str(largest)), "9" * 30]
    found = cleaning.clean(stage(spark, *[{column: v} for v in kept + gone])).collect()
    assert [r[column] for r in found] == kept


@pytest.mark.parametrize("change, column, expected", [
    ({}, "end_time", "01/05/2019 08:22"),
    ({"end_time": None, "trip_duration": "700.9"}, "end_time", "01/05/2019 08:21"),
    ({"end_time": "2019-01-05 08:22"}, "end_time", "01/05/2019 08:22"),
    ({"end_time": "02/30/2019 08:22"}, "end_time", "01/05/2019 08:22"),
    ({"end_time": "", "trip_duration": "86400"}, "end_time", "01/06/2019 08:10"),
    ({"start_station_name": "NULL"}, "start_station_name", "UNKNOWN"),
    ({"start_station_name": " "}, "start_station_name", "UNKNOWN"),
    ({"end_station_name": None}, "end_station_name", "UNKNOWN"),
    ({"end_station_name": "  C St "}, "end_station_name", "C St"),
    ({}, "user_type", "annual"),
    ({"user_type": "Casual Member\r"}, "user_type", "casual"),
    ({"user_type": "Corporate"}, "user_type", "Corporate"),
    ({"user_type": " "}, "user_type", "UNKNOWN"),
    ({"user_type": None}, "user_type", "UNKNOWN"),
    ({"bike_id": None}, "bike_id", "-1"),
    ({"bike_id": "X1"}, "bike_id", "-1"),
    ({"bike_id": "12"}, "bike_id", "12"),
    ({"model": None}, "model", "UNKNOWN"),
    ({"model": " EFIT "}, "model", "EFIT"),
])
def test_repairs(spark, change, column, expected):
    assert cleaning.clean(stage(spark, change)).first()[column] == expected


def test_audit_adds_up(spark):
    audit = cleaning.clean_audit(stage(spark, {}, {"trip_id": None}, {"trip_duration": "0"})).first()
    assert tuple(audit) == (3, 2, 1)


def test_stage_checks_find_each_kind(spark):
    report = {r["check"]: (r["violations"], r["status"]) for r in quality.stage_checks(stage(
        spark, {}, {"trip_id": "x"}, {"start_time": "13/45/2019 10:00"}, {"end_station_name": "NULL"},
        {"model": None})).collect()}
    assert report["trip_id not int"] == (1, "FAIL")
    assert report["start_time malformed"] == (0, "ok")
    assert report["start_time unparseable"] == (1, "FAIL")
    assert report["literal 'NULL' name"] == (1, "FAIL")
    assert report["model null"] == (1, "FAIL")


def test_clean_rows_pass_the_stage_checks(spark):
    dirty = stage(spark, {}, {"end_time": None}, {"user_type": None, "model": None, "bike_id": None},
                  {"start_station_name": "NULL"}, {"trip_id": "x"})
    assert quality.stage_checks(cleaning.clean(dirty)).where("status <> 'ok'").count() == 0
