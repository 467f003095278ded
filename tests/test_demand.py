from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidewheel.contract import PRIOR_FEATURES
from tidewheel.operators import baseline, dimensions, features, panel, pool, profile, splits

TRIPS = "station_id int, start_date date, hour int, year int"


def trips(spark, *rows):
    return spark.createDataFrame([(s, dt.date.fromisoformat(d), h, int(d[:4])) for s, d, h in rows], TRIPS)


def activity(frame):
    return pool.yearly_activity(panel.daily_counts(frame))


def test_zero_fill_two_stations_two_days(spark):
    daily = panel.daily_counts(trips(spark, (1, "2022-01-01", 8), (1, "2022-01-01", 8), (2, "2022-01-03", 0)))
    filled = panel.zero_filled_panel(daily, daily)
    got = {(r.station_id, str(r.start_date), r.hour): r.trip_count for r in filled.collect()}
    assert len(got) == filled.count() == 96
    assert {k: v for k, v in got.items() if v} == {(1, "2022-01-01", 8): 2, (2, "2022-01-03", 0): 1}
    assert "2022-01-02" not in {d for _, d, _ in got}


def test_days_of_other_stations_do_not_enter_the_grid(spark):
    daily = panel.daily_counts(trips(spark, (1, "2022-01-01", 8), (2, "2022-01-05", 8)))
    only = spark.createDataFrame([(1,)], "station_id int")
    assert panel.zero_filled_panel(only, daily).select("start_date").distinct().count() == 1


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 28), st.integers(0, 23)), min_size=1, max_size=60))
def test_zero_fill_keeps_totals_and_grain(spark, data):
    frame = trips(spark, *[(s, f"2022-02-{d:02d}", h) for s, d, h in data])
    daily = panel.daily_counts(frame)
    report = panel.panel_checks(panel.zero_filled_panel(daily, daily), frame, panel.zero_filled_panel(daily, daily))
    assert report.where("status <> 'ok'").count() == 0
    expected = {k: 0 for k in ()}
    for s, d, h in data:
        expected[(s, d, h)] = expected.get((s, d, h), 0) + 1
    got = {(r.station_id, r.start_date.day, r.hour): r.trip_count
           for r in panel.hourly_counts(frame).collect()}
    assert got == expected


def test_panel_checks_notice_lost_trips(spark):
    frame = trips(spark, (1, "2022-01-01", 8), (1, "2022-01-01", 9))
    daily = panel.daily_counts(frame.where("hour = 8"))
    filled = panel.zero_filled_panel(daily, daily)
    report = {r["check"]: r.violations for r in panel.panel_checks(
        filled.unionByName(filled.where("hour = 1")), frame, filled).collect()}
    assert report == {"trip total changed": 1, "duplicate station-hours": 1, "rows changed by enrichment": 1}


def test_pool_rules(spark):
    data = []
    for year in (2019, 2020):
        data += [(1, f"{year}-01-02", 5)] * 3 + [(1, f"{year}-12-30", 5)]          # busy, whole span
        data += [(2, f"{year}-01-03", 5)] * 2 + [(2, f"{year}-12-31", 5)] * 2      # ties with 1, loses by id
        data += [(3, f"{year}-01-05", 5)]                                           # whole span, never on top
    data += [(4, "2020-06-01", 5)] * 9                                             # busy, opened late
    names = spark.createDataFrame([(1, "One")], "dim_station_id int, dim_station_name string")
    chosen = pool.station_pool(activity(trips(spark, *data)), names, "2019-01-31", "2020-01-05", n=2).collect()
    assert [(r.station_id, r.station_name, r.top_years, r.best_rank) for r in chosen] == [
        (1, "One", 2, 1), (2, None, 1, 2)]


def test_pool_overlap(spark):
    a, b = (spark.createDataFrame([(i,) for i in ids], "station_id int") for ids in ([1, 2, 3], [2, 3, 4, 5]))
    assert tuple(pool.pool_overlap(a, b).first()) == (3, 4, 2, 1, 2)


def test_segment_keeps_type_years_and_duration(spark):
    fact = spark.createDataFrame(
        [(1, dt.date(2019, 1, 1), 5, 2019, 60, 1), (1, dt.date(2019, 1, 1), 5, 2019, 59, 1),
         (1, dt.date(2019, 1, 1), 5, 2019, 86400, 2), (1, dt.date(2023, 1, 1), 5, 2023, 90, 1),
         (2, dt.date(2019, 1, 1), 5, 2019, 86401, 1)],
        "fact_trip_start_station_id int, fact_trip_start_date_id date, fact_trip_start_hour int, start_year int, "
        "fact_trip_duration int, fact_trip_user_type_id int")
    kinds = spark.createDataFrame([(1, "annual"), (2, "casual")], "dim_user_type_id int, dim_user_type_name string")
    assert pool.segment(fact, kinds, "annual", [2019, 2020]).count() == 1


def test_coverage_and_gaps(spark, rows):
    fact = trips(spark, (1, "2022-01-01", 8), (1, "2022-01-04", 9), (1, "2022-01-04", 8), (1, "2022-01-06", 8))
    report = profile.coverage(fact, "start_date", "hour").first()
    assert (report.distinct_days, report.distinct_hours, report.span_days, report.missing_days) == (3, 2, 6, 3)
    assert rows(profile.gap_runs(fact, "start_date")) == [
        (dt.date(2022, 1, 2), dt.date(2022, 1, 3), 2), (dt.date(2022, 1, 5), dt.date(2022, 1, 5), 1)]


def test_quantiles_match_numpy(spark):
    values = [3, 61, 61, 70, 400, 90000, 61, 5000]
    fact = spark.createDataFrame([(v,) for v in values], "fact_trip_duration int")
    report = {r.measure: r.value for r in profile.duration_quantiles(fact, {"p50": 0.5, "p99": 0.99}).collect()}
    assert report["p50"] == np.quantile(values, 0.5) and math.isclose(report["p99"], np.quantile(values, 0.99))
    assert (report["below_minimum"], report["above_maximum"], report["p_max"]) == (1, 1, 90000)
    rough = {r.measure: r.value for r in profile.duration_quantiles(fact, {"p50": 0.5}, approximate=True).collect()}
    assert rough["p50"] == 61 and rough["above_maximum"] == 1


def test_funnel_is_cumulative(spark, rows):
    df = spark.createDataFrame([(i,) for i in range(10)], "x int")
    report = profile.funnel(df, {"above 3": F.col("x") > 3, "even": F.col("x") % 2 == 0})
    assert sorted((r.step, r.row_count, r.pct) for r in report.collect()) == [
        ("above 3", 6, 60.0), ("even", 3, 30.0), ("raw", 10, 100.0)]


@pytest.fixture(scope="module")
def two_years(spark):
    """Two stations, a few days of three years, one trip pattern per year."""
    data = []
    for year, n in ((2019, 1), (2020, 2), (2021, 4)):
        for day in ("01-01", "01-08", "02-03"):
            data += [(1, f"{year}-{day}", 7)] * n
        data += [(2, f"{year}-01-01", 9)]
    daily = panel.daily_counts(trips(spark, *data))
    days = dimensions.calendar_between(spark, dt.date(2019, 1, 1), dt.date(2021, 12, 31),
                                       spark.createDataFrame([(dt.date(2020, 1, 1),)], "holiday date"))
    return features.featured(panel.day_panel(daily, daily), days).cache()


def test_prior_year_means(two_years):
    py_hour, py_month = PRIOR_FEATURES
    first = two_years.where("year = 2019").agg(F.count(py_hour), F.count(py_month)).first()
    assert tuple(first) == (0, 0)
    later = two_years.where("year = 2020 and station_id = 1 and month = 1 and hour = 3").select(py_month).distinct()
    # January 2019: two days x 24 hours, two trips
    assert [r[0] for r in later.collect()] == [2 / 48]
    assert features.prior_year_checks(two_years).where("status <> 'ok'").count() == 0
    broken = two_years.withColumn(py_month, F.col(py_month) + 1)
    assert features.prior_year_checks(broken).where("status <> 'ok'").count() == 1


def test_population_and_flags(two_years):
    population = {r.year: r[1:] for r in features.feature_population(two_years).collect()}
    assert population[2019] == (0.0, 0.0) and population[2020][1] == 1.0
    holiday = two_years.where("is_holiday = 1").select("start_date").distinct().collect()
    assert [r.start_date for r in holiday] == [dt.date(2020, 1, 1)]


def test_cyclical_wraps(two_years):
    assert features.wrap_check(two_years).first().status == "ok"
    six = two_years.where("hour = 6").first()
    assert math.isclose(six.hour_sin, 1.0) and abs(six.hour_cos) < 1e-12


def test_parity_counts_differences(two_years):
    keys = ["station_id", "start_date", "hour"]
    changed = two_years.withColumn("season", F.when(F.col("hour") == 0, "x").otherwise(F.col("season"))).where(
        "not (hour = 1 and station_id = 2)")
    report = {r["check"]: r.violations for r in features.parity(two_years, changed, keys, ["season", "hour_sin"]).collect()}
    days = two_years.select("start_date").distinct().count()
    assert report == {"unpaired rows": days, "season": 2 * days, "hour_sin": 0}


PERIODS = {"train": [2019], "val": [2020], "test": [2021]}


def test_split_is_chronological(two_years):
    split = splits.split_by_period(two_years, PERIODS)
    assert "year" not in split.columns
    summary = {r.split: (str(r.from_date), str(r.to_date), r.trips) for r in splits.split_summary(split).collect()}
    assert summary["train"] == ("2019-01-01", "2019-02-03", 4) and summary["test"][2] == 13
    assert splits.split_checks(split, two_years, list(PERIODS)).where("status <> 'ok'").count() == 0
    mixed = split.withColumn("split", F.when(F.col("split") == "val", "train").when(
        F.col("split") == "train", "val").otherwise(F.col("split")))
    assert splits.split_checks(mixed, two_years, list(PERIODS)).where("status <> 'ok'").count() == 1


def test_split_refuses_leaks_and_overlap(two_years):
    with pytest.raises(ValueError, match="year"):
        splits.split_by_period(two_years, PERIODS, features=["hour", "year"])
    with pytest.raises(ValueError, match="overlap"):
        splits.split_by_period(two_years, {"train": [2019, 2020], "val": [2020]})
    with pytest.raises(ValueError, match="missing"):
        splits.split_by_period(two_years, PERIODS, features=["weather"])


def test_contract_row(spark, two_years):
    split = splits.split_by_period(two_years, PERIODS)
    mae = spark.createDataFrame([(0.25,)], "mae double")
    row = splits.split_contract(split, PERIODS, "annual", mae, "m").first()
    assert row.station_pool == [1, 2] and row.baseline_val_mae == 0.25 and len(row.features) == 17


def test_cells_fall_back_to_the_global_mean(spark):
    train = spark.createDataFrame([(1, 7, 1, 2), (1, 7, 1, 4), (1, 8, 1, 0)],
                                  "station_id int, hour int, weekday int, trip_count bigint")
    ask = spark.createDataFrame([(1, 7, 1, 5), (1, 9, 1, 1)], train.schema)
    cells = baseline.fit_cells(train, {"mean": F.avg("trip_count"), "q80": baseline.quantile_of(0.8)})
    got = {r.hour: (r["mean"], r.q80, r.fallback) for r in baseline.predict_cells(ask, cells, ["mean", "q80"]).collect()}
    assert got[7][0] == 3.0 and math.isclose(got[7][1], np.quantile([2, 4], 0.8)) and not got[7][2]
    assert got[9] == (2.0, 2.0, True)
    assert tuple(baseline.unseen_cells(ask, cells).first()) == (1, 1)
