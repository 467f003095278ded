from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.operators import bootstrap, metrics

PEAK = {7, 8, 9, 16, 17, 18, 19}


def tall(spark, data):
    rows = [(s, dt.date(2022, 1, 1), h, 0, float(y), m, float(p)) for s, h, y, m, p in data]
    return spark.createDataFrame(
        rows, "station_id int, start_date date, hour int, is_weekend int, y double, model string, pred double")


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(1)
    y = rng.poisson(6, 200)
    return [(int(i % 5), int(i % 24), int(v), "m", float(v + rng.normal(0, 3) - 1)) for i, v in enumerate(y)]


def test_accuracy_against_numpy(spark, sample):
    row = metrics.accuracy(tall(spark, sample)).first()
    h, y, p = (np.array([r[i] for r in sample], dtype=float) for i in (1, 2, 4))
    p = p.clip(0)
    peak, busy = np.isin(h, list(PEAK)), y >= 11
    assert math.isclose(row.mae, np.abs(y - p).mean()) and math.isclose(row.rmse, np.sqrt(((y - p) ** 2).mean()))
    assert math.isclose(row.mae_peak, np.abs(y - p)[peak].mean())
    assert math.isclose(row.mae_offpeak, np.abs(y - p)[~peak].mean())
    assert math.isclose(row.mae_busy, np.abs(y - p)[busy].mean()) and math.isclose(row.bias_busy, (p - y)[busy].mean())


def test_cost_against_numpy(spark, sample):
    row = metrics.cost(tall(spark, sample), {"m": 0.8}).first()
    y, p = (np.array([r[i] for r in sample], dtype=float) for i in (2, 4))
    p, busy = p.clip(0), y >= 11
    d = y - p
    assert math.isclose(row.under_rate_busy, (p[busy] < y[busy]).mean())
    assert math.isclose(row.shortfall_busy, 1 - p[busy].sum() / y[busy].sum())
    assert math.isclose(row.pinball, np.maximum(0.8 * d, -0.2 * d).mean())
    assert math.isclose(row.over_supply, np.maximum(-d, 0).mean())
    assert math.isclose(row.unmet_pct, np.maximum(d, 0).sum() / y.sum())
    assert math.isclose(row.over_pct, np.maximum(-d, 0).sum() / y.sum())


def test_no_busy_rows_give_null(spark):
    row = metrics.accuracy(tall(spark, [(1, 10, 0, "m", -3.0), (1, 10, 2, "m", 2.0)])).first()
    assert row.mae == 0.0 and row.mae_busy is None and row.mae_peak is None
    assert metrics.cost(tall(spark, [(1, 10, 2, "m", 2.0)]), {}).first().shortfall_busy is None


def test_busy_threshold_is_inclusive(spark):
    assert metrics.accuracy(tall(spark, [(1, 10, 11, "m", 10.0)])).first().mae_busy == 1.0


@pytest.mark.parametrize("y, band", [(0, "0"), (1, "1-2"), (2, "1-2"), (3, "3-5"), (5, "3-5"), (6, "6-10"), (10, "6-10"),
                                     (11, "11+"), (99, "11+")])
def test_band_edges(spark, y, band):
    assert metrics.by_band(tall(spark, [(1, 1, y, "m", 1.0)])).first().band == band


def test_bands_share_and_shortfall(spark):
    report = {r.band: r for r in metrics.by_band(
        tall(spark, [(1, 1, 0, "m", 1.0), (1, 1, 2, "m", 1.0), (1, 1, 6, "m", 3.0)])).collect()}
    assert report["0"].shortfall is None and report["1-2"].shortfall == 0.5
    assert report["6-10"].pct_of_trips == 0.75


def scores(spark):
    data = [(1, 17, 12, "base", 6.0), (1, 17, 0, "base", 1.0), (1, 17, 12, "q", 9.0), (1, 17, 0, "q", 3.0)]
    return tall(spark, data)


def test_comparison_and_tradeoff(spark):
    compared = {r.model: r.vs_baseline for r in metrics.compare(metrics.accuracy(scores(spark)), "base").collect()}
    assert compared["base"] == 0.0 and math.isclose(compared["q"], 1 - 3.0 / 3.5)
    costs = metrics.cost(scores(spark), {"q": 0.8})
    trade = {r.model: r for r in metrics.tradeoff(costs, "base").collect()}
    assert math.isclose(trade["q"].shortfall_closed, 0.5) and math.isclose(trade["q"].over_ratio, 3.0)
    decided = {r.model: r for r in metrics.decision(costs, "base", "q").collect()}
    assert decided["q"].recommended and decided["q"].unmet_pct == 25.0 and math.isclose(decided["q"].unmet_lower, 0.5)


def test_leaderboard_order_and_spread(spark):
    board = metrics.leaderboard(metrics.accuracy(scores(spark))).collect()
    assert [r.model for r in board] == ["q", "base"] and math.isclose(board[0].spread, 3.5 / 3.0 - 1)


def test_station_reports(spark):
    data = [(1, 1, 4, "m", 2.0), (1, 2, 4, "m", 4.0), (2, 1, 1, "m", 0.0), (3, 1, 0, "m", 0.0)]
    report = metrics.by_station(tall(spark, data)).collect()
    assert [(r.station_id, r.total_trips, r.mae, r.shortfall) for r in report] == [
        (1, 8.0, 1.0, 0.25), (2, 1.0, 1.0, 1.0), (3, 0.0, 0.0, None)]
    assert metrics.station_spread(metrics.by_station(tall(spark, data))).first().median_mae == 1.0
    bins = {r.bin: r.row_count for r in metrics.histogram(metrics.by_station(tall(spark, data)), "shortfall", 24).collect()}
    assert bins == {0: 1, 23: 1}


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [tuple(r) for r in metrics.histogram(df, "v", 24).collect()] == [(0, 2)]


def test_unmet_by_hour_is_a_share(spark):
    report = metrics.unmet_by_hour(tall(spark, [(1, 16, 4, "m", 1.0), (2, 16, 4, "m", 9.0), (1, 12, 4, "m", 0.0)]))
    assert [tuple(r) for r in report.collect()] == [("m", 16, 0.375)]


def test_profile_and_peak_hours(spark):
    panel = spark.createDataFrame([(8, 0, 5), (8, 0, 7), (9, 0, 6), (17, 0, 9), (8, 1, 1)],
                                  "hour int, is_weekend int, trip_count bigint")
    profile = metrics.hour_profile(panel)
    assert [tuple(r) for r in profile.collect()] == [(8, 6.0, 1.0), (9, 6.0, None), (17, 9.0, None)]
    assert [r.hour for r in metrics.peak_hours(profile, 2).collect()] == [17, 8]


def test_busiest_slice_breaks_ties_by_id(spark):
    frame = spark.createDataFrame(
        [(2, dt.date(2022, 1, 2), 1, 3), (1, dt.date(2022, 1, 2), 5, 2), (1, dt.date(2022, 1, 2), 4, 1),
         (1, dt.date(2022, 1, 9), 4, 0)], "station_id int, start_date date, hour int, trip_count bigint")
    got = metrics.busiest_slice(frame, "2022-01-01", "2022-01-07").collect()
    assert [(r.station_id, r.hour) for r in got] == [(1, 4), (1, 5)]


def test_bootstrap_weights_are_poisson(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(3000)], "id int, d double")
    sums = bootstrap.replicate_gaps(df, "d", 40)
    assert sums.count() == 40 and all(math.isclose(r.gap, 1.0) for r in sums.collect())
    for bit, mean in ((0, 1), (3, 8), (5, 32), (9, 512)):
        draws = spark.range(4000).select(bootstrap._draw(
            F.lit(bit), F.pmod(F.xxhash64("id"), F.lit(2 ** 32)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2 ** 32))).alias("w"))
        row = draws.agg(F.avg("w").alias("m"), F.variance("w").alias("v")).first()
        assert abs(row.m - mean) < 4 * math.sqrt(mean / 4000) and abs(row.v / mean - 1) < 0.1
    assert bootstrap.cumulative(1)[:3] == [1580030168, 3160060337, 3950075421]


def test_bootstrap_of_equal_rows_spreads_like_that_of_single_ones(spark):
    df = spark.createDataFrame([(i, float(i % 2)) for i in range(5000)], "id int, d double")
    spread = bootstrap.replicate_gaps(df, "d").agg(F.stddev("gap")).first()[0]
    assert abs(spread / (0.5 / math.sqrt(5000)) - 1) < 0.2


def test_bootstrap_interval_is_close_to_the_normal_one(spark):
    rng = np.random.default_rng(5)
    gap = rng.normal(0.2, 1.0, 4000)
    df = spark.createDataFrame([(i, 1 + float(g), 1.0) for i, g in enumerate(gap)], "id int, a double, b double")
    row = bootstrap.paired_ci(df, "a", "b").first()
    half = 1.96 * gap.std() / math.sqrt(len(gap))
    assert row.replicates == 200 and math.isclose(row.mean_gap, gap.mean())
    assert abs(row.low - (gap.mean() - half)) < 0.4 * half and abs(row.high - (gap.mean() + half)) < 0.4 * half
    assert bootstrap.paired_ci(df.repartition(7), "a", "b").first().low == pytest.approx(row.low, abs=1e-9)
