from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidewheel.contract import SERVICE_HOLIDAYS
from tidewheel.functions.calendar import statutory_holidays
from tidewheel.operators import dimensions, facts, quality
from tidewheel.operators.numbering import with_dense_id


def sightings(spark, *triples):
    parsed = [(s, n, dt.datetime.fromisoformat(t)) for s, n, t in triples]
    return spark.createDataFrame(parsed, "station_id int, station_name string, seen_at timestamp_ntz")


def test_latest_real_name_wins(spark, rows):
    seen = sightings(
        spark, (1, "Old", "2019-01-01"), (1, "New", "2020-01-01"), (1, "Mid", "2019-06-01"),
        (2, "UNKNOWN", "2021-01-01"), (2, "Real", "2019-01-01"), (3, "UNKNOWN", "2020-01-01"),
        (4, "A", "2020-01-01"), (4, "B", "2020-01-01"))
    assert rows(dimensions.dim_station(seen)) == [(1, "New"), (2, "Real"), (3, "UNKNOWN"), (4, "B")]


def test_bike_model_prefers_a_real_one(spark, rows):
    stage = spark.createDataFrame([("1", "UNKNOWN"), ("1", "EFIT"), ("2", "UNKNOWN"), ("-1", "UNKNOWN"), ("1", "ABC"),
                                   ("x", "EFIT")], "bike_id string, model string")
    assert rows(dimensions.dim_bike(stage)) == [(-1, "UNKNOWN"), (1, "EFIT"), (2, "UNKNOWN")]


def test_user_types_are_numbered_by_name(spark, rows):
    stage = spark.createDataFrame([("casual",), ("annual",), ("casual",), (None,), ("UNKNOWN",)], "user_type string")
    assert rows(dimensions.dim_user_type(stage)) == [(1, "UNKNOWN"), (2, "annual"), (3, "casual")]


def test_calendar_attributes_match_the_standard_library(spark):
    holidays = spark.createDataFrame([(dt.date(2020, 1, 1),)], "holiday date")
    first, last = dt.date(2018, 12, 25), dt.date(2021, 1, 5)
    days = {r.dim_date_id: r for r in dimensions.calendar_between(spark, first, last, holidays).collect()}
    assert len(days) == (last - first).days + 1
    names = {12: "winter", 1: "winter", 2: "winter", 3: "spring", 4: "spring", 5: "spring", 6: "summer", 7: "summer",
             8: "summer", 9: "fall", 10: "fall", 11: "fall"}
    for day, row in days.items():
        weekday = day.isoweekday() % 7 + 1
        assert (row.dim_date_week, row.dim_date_weekday, row.dim_date_is_weekend) == (
            day.isocalendar()[1], weekday, weekday in (1, 7))
        assert (row.dim_date_quarter, row.dim_date_season) == ((day.month + 2) // 3, names[day.month])
        assert row.dim_date_is_holiday == (day == dt.date(2020, 1, 1))


def test_statutory_rule_against_the_service_list(spark):
    years = spark.createDataFrame([(y,) for y in range(2019, 2024)], "year int")
    ruled = {r.holiday.isoformat() for r in statutory_holidays(years).collect()}
    assert ruled == set(SERVICE_HOLIDAYS)
    assert {"2021-12-27", "2021-12-28", "2022-01-03", "2023-01-02"} < ruled  # observed days


def test_family_day_starts_in_2008(spark):
    days = statutory_holidays(spark.createDataFrame([(2007,), (2008,)], "year int"))
    assert [r.holiday.isoformat() for r in days.where("month(holiday) = 2").collect()] == ["2008-02-18"]


def check_numbering(df, order):
    numbered = with_dense_id(df, order, "id", partitions=5).collect()
    assert sorted(r.id for r in numbered) == list(range(1, len(numbered) + 1))
    keys = [tuple(r[c] for c in order) for r in sorted(numbered, key=lambda r: r.id)]
    assert keys == sorted(keys)
    return numbered


def test_dense_ids_with_a_hot_key_and_equal_copies(spark):
    rng = random.Random(3)
    data = [(7, i) for i in range(400)] + [(9, 1)] * 300 + [(rng.randrange(50), rng.randrange(9)) for _ in range(500)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k int, v int").repartition(6)
    numbered = check_numbering(df, ["k"])
    assert sorted((r.k, r.v) for r in numbered) == sorted(data)


def test_dense_ids_repeat_on_reload(spark):
    data = [(i % 3, i) for i in range(300)]
    one = with_dense_id(spark.createDataFrame(data, "k int, v int").repartition(4), ["k"], "id", 3)
    two = with_dense_id(spark.createDataFrame(data[::-1], "k int, v int").repartition(7), ["k"], "id", 5)
    assert one.exceptAll(two).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.text("ab", max_size=2)), min_size=1, max_size=40))
def test_dense_ids_for_any_rows(spark, data):
    check_numbering(spark.createDataFrame(data, "k int, v string"), ["k"])


def stage_row(**change):
    base = dict(trip_id="5", trip_duration="730.9", start_time="12/31/2019 23:55", start_station_id="7000",
                start_station_name="A", end_time="01/01/2020 00:07", end_station_id="7001", end_station_name="B",
                bike_id="-1", user_type="annual", model="UNKNOWN", source_year="2019")
    return {**base, **change}


def frame(spark, *changes):
    return spark.createDataFrame([stage_row(**c) for c in changes])


def test_fact_of_a_trip_over_new_year(spark):
    stage = frame(spark, {}, {"trip_id": "3", "user_type": "casual"})
    fact = facts.build_fact(stage, dimensions.dim_user_type(stage)).orderBy("fact_trip_id").collect()
    assert [(r.fact_trip_id, r.fact_trip_source_id, r.fact_trip_user_type_id) for r in fact] == [(1, 3, 2), (2, 5, 1)]
    row = fact[1]
    assert (row.fact_trip_duration, row.fact_trip_bike_id, row.start_year, row.start_month) == (730, -1, 2019, 12)
    assert row.fact_trip_start_date_id == dt.date(2019, 12, 31) and row.fact_trip_end_date_id == dt.date(2020, 1, 1)
    assert (row.fact_trip_start_hour, row.fact_trip_start_minute, row.fact_trip_end_hour, row.fact_trip_end_minute) == (
        23, 55, 0, 7)
    report = {r["check"]: r.violations for r in quality.fact_checks(
        facts.build_fact(stage, dimensions.dim_user_type(stage)), stage).collect()}
    assert set(report.values()) == {0}


def test_fact_checks_notice_damage(spark):
    stage = frame(spark, {}, {}, {"end_time": "12/31/2019 23:00"}, {"user_type": None})
    fact = facts.build_fact(stage, dimensions.dim_user_type(stage))
    report = {r["check"]: r.violations for r in quality.fact_checks(fact, stage).collect()}
    assert report["duplicate fact_trip_source_id"] == 2
    assert report["end before start"] == 1
    assert report["rows lost from stage"] == 1


def test_orphans_count_rows_not_keys(spark, rows):
    fact = spark.createDataFrame([(1, 1), (1, 2), (9, 2), (9, 2), (None, 2)], "a int, b int")
    dim = spark.createDataFrame([(1,), (2,)], "id int")
    report = quality.orphans(fact, [("a", "dim", dim, "id"), ("b", "dim", dim, "id")])
    assert rows(report) == [("a", "dim", 3, "FAIL"), ("b", "dim", 0, "ok")]


def test_dim_date_checks_find_gaps_and_duplicates(spark):
    holidays = spark.createDataFrame([], "holiday date")
    dim = dimensions.calendar_between(spark, dt.date(2019, 1, 1), dt.date(2019, 1, 10), holidays)
    broken = dim.where("dim_date_id <> date'2019-01-05'").unionByName(dim.where("dim_date_id = date'2019-01-02'")).withColumn(
        "dim_date_weekday", F.when(F.col("dim_date_day") == 3, 1).otherwise(F.col("dim_date_weekday")))
    report = {r["check"]: r.violations for r in quality.dim_date_checks(broken, 2019, 2019).collect()}
    assert (report["gaps"], report["duplicates"], report["weekday mismatch"], report["weekend mismatch"]) == (1, 1, 1, 1)


def test_star_query_on_four_trips(spark, rows):
    holidays = spark.createDataFrame([], "holiday date")
    days = dimensions.calendar_between(spark, dt.date(2019, 1, 1), dt.date(2019, 7, 31), holidays)
    fact = spark.createDataFrame(
        [(dt.date(2019, 1, 1), 1, 600, 7), (dt.date(2019, 1, 2), 1, 900, 7), (dt.date(2019, 7, 1), 1, 60, 8),
         (dt.date(2019, 7, 1), 2, 30, 9)],
        "fact_trip_start_date_id date, fact_trip_user_type_id int, fact_trip_duration int, fact_trip_start_station_id int")
    kinds = spark.createDataFrame([(1, "annual"), (2, "casual")], "dim_user_type_id int, dim_user_type_name string")
    assert rows(facts.season_by_user_type(fact, days, kinds)) == [
        ("summer", "annual", 1, 1.0), ("summer", "casual", 1, 0.5), ("winter", "annual", 2, 12.5)]
    stations = spark.createDataFrame([(7, "A"), (8, "B"), (9, "B")], "dim_station_id int, dim_station_name string")
    top = facts.top_stations_by_name(fact, stations, 2).collect()
    assert [tuple(r) for r in top] == [("A", 2), ("B", 2)]


def test_null_profile_and_value_counts(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, None), ("b", "y")], "k string, v string")
    assert rows(quality.null_profile(df)) == [("k", 1, 0.25), ("v", 2, 0.5)]
    assert [tuple(r) for r in quality.value_counts(df, "k").collect()][0] == ("a", 2)
    assert quality.duplicates(df, "k").first().duplicates == 1
