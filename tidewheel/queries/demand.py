"""Panel, features, splits, lookups and baseline cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.contract import CELL_KEYS, TARGET
from tidewheel.functions.calendar import statutory_holidays
from tidewheel.functions.encoding import rounded
from tidewheel.operators import baseline, features, metrics, panel, pool, requests, splits
from tidewheel.queries.check_sql import with_ctes
from tidewheel.queries.registry import query
from tidewheel.queries.standins import (YEAR_SPLIT, event_counts, event_daily, event_panel, ordered_trips, suppliers,
                                        year_calendar, year_daily, year_days, year_features, year_pool, year_split)
from tidewheel.session import materialize, scratch_path
from tidewheel.sources import records, tables


@query("station_hour_counts", with_ctes("""
    SELECT station_id, start_date, hour, count(*) AS trip_count FROM departures GROUP BY ALL""", "departures"))
def station_hour_counts(spark: SparkSession, folder: str) -> DataFrame:
    return panel.hourly_counts(pool.departures(ordered_trips(spark, folder)))


@query("station_hour_grid", with_ctes("SELECT station_id, start_date, hour FROM ev_panel", "ev_panel"))
def station_hour_grid(spark: SparkSession, folder: str) -> DataFrame:
    daily = event_daily(spark, folder)
    return panel.station_hour_grid(daily, daily)


@query("zero_filled_panel", with_ctes("SELECT * FROM ev_panel", "ev_panel"))
def zero_filled_panel(spark: SparkSession, folder: str) -> DataFrame:
    return event_counts(spark, folder)


@query("year_panel_by_station", with_ctes("""
    SELECT station_id, hour, count(*) AS row_count, CAST(sum(trip_count) AS BIGINT) AS trips,
        count(*) FILTER (trip_count = 0) AS zero_rows, CAST(max(trip_count) AS BIGINT) AS busiest
    FROM panel GROUP BY ALL""", "panel"))
def year_panel_by_station(spark: SparkSession, folder: str) -> DataFrame:
    """The panel over all years and pool stations, summed per station and hour."""
    return year_calendar(spark, folder).groupBy("station_id", "hour").agg(
        F.count("*").alias("row_count"), F.sum(TARGET).alias("trips"),
        F.count_if(F.col(TARGET) == 0).alias("zero_rows"), F.max(TARGET).alias("busiest"))


@query("calendar_features", with_ctes("SELECT * FROM ev_cal_panel", "ev_cal_panel"))
def calendar_features(spark: SparkSession, folder: str) -> DataFrame:
    return event_panel(spark, folder)


@query("cyclical_features", with_ctes("""
    SELECT station_id, start_date, hour, round(sin(2 * pi() * hour / 24), 6) + 0.0 AS hour_sin,
        round(cos(2 * pi() * hour / 24), 6) + 0.0 AS hour_cos, round(sin(2 * pi() * weekday / 7), 6) + 0.0 AS weekday_sin,
        round(cos(2 * pi() * weekday / 7), 6) + 0.0 AS weekday_cos, round(sin(2 * pi() * month / 12), 6) + 0.0 AS month_sin,
        round(cos(2 * pi() * month / 12), 6) + 0.0 AS month_cos
    FROM ev_cal_panel""", "ev_cal_panel"))
def cyclical_features(spark: SparkSession, folder: str) -> DataFrame:
    frame = features.add_cyclical(event_panel(spark, folder))
    names = [f"{c}_{part}" for c in ("hour", "weekday", "month") for part in ("sin", "cos")]
    return frame.select("station_id", "start_date", "hour", *[rounded(F.col(n)).alias(n) for n in names])


@query("cyclical_wrap_check", with_ctes("""
    , h AS (SELECT DISTINCT hour, sin(2 * pi() * hour / 24) AS s, cos(2 * pi() * hour / 24) AS c FROM ev_panel)
    SELECT round(sqrt((a.s - z.s) ** 2 + (a.c - z.c) ** 2), 6) AS wrap_distance,
        round(sqrt((o.s - z.s) ** 2 + (o.c - z.c) ** 2), 6) AS step_distance, 'ok' AS status
    FROM h a, h z, h o WHERE a.hour = 23 AND z.hour = 0 AND o.hour = 1""", "ev_panel"))
def cyclical_wrap_check(spark: SparkSession, folder: str) -> DataFrame:
    report = features.wrap_check(features.add_cyclical(event_panel(spark, folder)))
    return report.select(rounded(F.col("wrap_distance")).alias("wrap_distance"),
                         rounded(F.col("step_distance")).alias("step_distance"), "status")


@query("prior_year_features", with_ctes("""
    SELECT station_id, year, hour, weekday, count(*) AS row_count,
        round(max(py_station_hour_weekday_mean), 6) AS hour_weekday_mean,
        round(sum(py_station_month_mean), 4) AS month_mean_sum, count(py_station_month_mean) AS month_mean_rows
    FROM featured GROUP BY ALL""", "featured"))
def prior_year_features(spark: SparkSession, folder: str) -> DataFrame:
    """Both prior-year means over the whole panel, gathered per cell and year."""
    return year_features(spark, folder).groupBy("station_id", "year", "hour", "weekday").agg(
        F.count("*").alias("row_count"), rounded(F.max("py_station_hour_weekday_mean")).alias("hour_weekday_mean"),
        rounded(F.sum("py_station_month_mean"), 4).alias("month_mean_sum"),
        F.count("py_station_month_mean").alias("month_mean_rows"))


@query("feature_population", with_ctes("""
    SELECT year, round(avg((py_station_hour_weekday_mean IS NOT NULL)::INT), 6) AS py_station_hour_weekday_mean,
        round(avg((py_station_month_mean IS NOT NULL)::INT), 6) AS py_station_month_mean
    FROM featured GROUP BY 1""", "featured"))
def feature_population(spark: SparkSession, folder: str) -> DataFrame:
    report = features.feature_population(year_features(spark, folder))
    return report.select("year", *[F.round(c, 6).alias(c) for c in report.columns[1:]])


@query("panel_summary", with_ctes("""
    SELECT year, count(*) AS row_count, count(DISTINCT station_id) AS stations, CAST(sum(trip_count) AS BIGINT) AS trips,
        round(100.0 * count(*) FILTER (trip_count = 0) / count(*), 1) AS pct_zero
    FROM cal_panel GROUP BY 1""", "cal_panel"))
def panel_summary(spark: SparkSession, folder: str) -> DataFrame:
    return panel.panel_summary(year_calendar(spark, folder))


@query("dq_panel", with_ctes("""
    SELECT unnest(['trip total changed', 'duplicate station-hours', 'rows changed by enrichment']) AS "check",
        unnest([CAST(abs(sum(n * trip_count) - (SELECT count(*) FROM pooled)) AS BIGINT), CAST(sum(n - 1) AS BIGINT),
            CAST(abs(sum(n) - (SELECT count(*) FROM cal_panel)) AS BIGINT)]) AS violations, 'ok' AS status
    FROM (SELECT station_id, start_date, hour, trip_count, count(*) AS n FROM panel GROUP BY ALL)""", "cal_panel"))
def dq_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Against the trips themselves: an independent count of pool departures."""
    enriched = materialize(year_calendar(spark, folder), "panel")
    counts = enriched.select("station_id", "start_date", "hour", TARGET)
    trips = pool.keep_pool(pool.departures(ordered_trips(spark, folder)), year_pool(spark, folder))
    return panel.panel_checks(counts, trips, enriched)


@query("dq_prior_year", with_ctes("""
    SELECT 'py_station_hour_weekday_mean' AS feature, count(*) AS cells, CAST(0 AS BIGINT) AS violations, 'ok' AS status
    FROM (SELECT DISTINCT station_id, hour, weekday, year FROM cal_panel)
    UNION ALL SELECT 'py_station_month_mean', count(*), 0, 'ok'
    FROM (SELECT DISTINCT station_id, month, year FROM cal_panel)""", "cal_panel"))
def dq_prior_year(spark: SparkSession, folder: str) -> DataFrame:
    return features.prior_year_checks(year_features(spark, folder))


@query("feature_parity", with_ctes("""
    SELECT unnest(['unpaired rows', 'season', 'quarter', 'month', 'weekday', 'week_of_year', 'is_weekend', 'is_holiday',
            'hour_sin', 'hour_cos', 'weekday_sin', 'weekday_cos', 'month_sin', 'month_cos']) AS "check",
        CAST(0 AS BIGINT) AS violations, 'ok' AS status
    FROM (SELECT count(*) FROM ev_panel)""", "ev_panel"))
def feature_parity(spark: SparkSession, folder: str) -> DataFrame:
    """Features the service derives from (date, hour) against those of the panel."""
    stored = features.add_cyclical(event_panel(spark, folder))
    holidays = statutory_holidays(stored.select("year").distinct())
    rebuilt = requests.derived_features(stored.select("station_id", "start_date", "hour"), holidays)
    derived = ["season", "quarter", "month", "weekday", "week_of_year", "is_weekend", "is_holiday", "hour_sin",
               "hour_cos", "weekday_sin", "weekday_cos", "month_sin", "month_cos"]
    return features.parity(rebuilt, stored, ["station_id", "start_date", "hour"], derived)


@query("split_summary", with_ctes("""
    SELECT split, count(*) AS row_count, CAST(sum(trip_count) AS BIGINT) AS trips, min(start_date) AS from_date,
        max(start_date) AS to_date FROM ysplit GROUP BY 1""", "ysplit"))
def split_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Freeze the split on disk, one folder per part, and summarise what was read back."""
    path = scratch_path(spark, "split")
    split = splits.split_by_period(year_features(spark, folder), YEAR_SPLIT)
    tables.write_partitioned(split, path, ["split"], gather=False)
    return splits.split_summary(tables.read_table(spark, path))


@query("dq_split", with_ctes("""
    SELECT unnest(['train/val overlap', 'val/test overlap', 'target sum changed']) AS "check",
        unnest([(max(start_date) FILTER (split = 'train') >= min(start_date) FILTER (split = 'val'))::BIGINT,
            (max(start_date) FILTER (split = 'val') >= min(start_date) FILTER (split = 'test'))::BIGINT,
            CAST(sum(trip_count) - (SELECT sum(trip_count) FROM panel) AS BIGINT)]) AS violations, 'ok' AS status
    FROM ysplit""", "ysplit"))
def dq_split(spark: SparkSession, folder: str) -> DataFrame:
    days = year_days(spark, folder)
    split = splits.split_by_period(panel.unfold(days), YEAR_SPLIT, features=CELL_KEYS)
    return splits.split_checks(materialize(split, "split"), panel.unfold(days), list(YEAR_SPLIT))


@query("dataset_fingerprint", with_ctes("""
    , digests AS (SELECT md5(concat_ws(chr(31), CAST(station_id AS VARCHAR), CAST(hour AS VARCHAR),
        CAST(weekday AS VARCHAR), season, CAST(trip_count AS VARCHAR), CAST(start_date AS VARCHAR))) AS h
        FROM ev_cal_panel)
    SELECT count(*) AS row_count, bit_xor(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS xor_digest,
        CAST(sum(CAST('0x' || substr(h, 17, 8) AS BIGINT)) AS VARCHAR) AS sum_digest FROM digests""", "ev_cal_panel"))
def dataset_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return records.fingerprint(event_panel(spark, folder),
                               ["station_id", "hour", "weekday", "season", TARGET, "start_date"])


_SCORED = """
    , cell AS (SELECT station_id, hour, weekday, avg(trip_count) AS m FROM ysplit WHERE split = 'train' GROUP BY ALL),
    scored AS (SELECT y.*, coalesce(m, (SELECT avg(trip_count) FROM ysplit WHERE split = 'train')) AS p
        FROM ysplit y LEFT JOIN cell USING (station_id, hour, weekday))"""


def _split_with_baseline(spark: SparkSession, folder: str,
                         daily: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    frozen = year_split(spark, folder, CELL_KEYS, daily)
    cells = baseline.fit_cells(frozen.where("split = 'train'"), {"baseline": F.avg(TARGET)})
    return frozen, baseline.predict_cells(frozen, cells, ["baseline"])


@query("baseline_cells", with_ctes("""
    SELECT station_id, hour, weekday, round(avg(trip_count), 6) AS baseline, CAST(sum(trip_count) AS BIGINT) AS cell_sum,
        count(*) AS cell_rows FROM ysplit WHERE split = 'train' GROUP BY ALL""", "ysplit"))
def baseline_cells(spark: SparkSession, folder: str) -> DataFrame:
    train = year_split(spark, folder, CELL_KEYS).where("split = 'train'")
    return baseline.fit_cells(train, {"baseline": rounded(F.avg(TARGET))})


@query("baseline_predict", with_ctes(f"""{_SCORED}
    SELECT split, station_id, start_date, count(*) AS row_count, round(sum(p), 4) AS predicted,
        round(sum(abs(trip_count - p)), 4) AS absolute_error
    FROM scored WHERE split <> 'train' GROUP BY ALL""", "ysplit"))
def baseline_predict(spark: SparkSession, folder: str) -> DataFrame:
    _, scored = _split_with_baseline(spark, folder)
    return scored.where("split <> 'train'").groupBy("split", "station_id", "start_date").agg(
        F.count("*").alias("row_count"), rounded(F.sum("baseline"), 4).alias("predicted"),
        rounded(F.sum(F.abs(F.col(TARGET) - F.col("baseline"))), 4).alias("absolute_error"))


@query("split_contract", with_ctes(f"""{_SCORED}
    SELECT 'all' AS segment, 17 AS feature_count, 'station_id' AS first_feature,
        list_sort(list(DISTINCT station_id)) AS station_pool, [1995, 1996, 1997, 1998] AS train_years,
        [1999] AS val_years, [2000, 2001] AS test_years,
        round(avg(abs(trip_count - p)) FILTER (split = 'val'), 6) AS baseline_val_mae FROM scored""", "ysplit"))
def split_contract(spark: SparkSession, folder: str) -> DataFrame:
    daily = year_daily(spark, folder)
    _, scored = _split_with_baseline(spark, folder, daily)
    frozen = year_split(spark, folder, daily=daily)
    mae = scored.where("split = 'val'").agg(F.avg(F.abs(F.col(TARGET) - F.col("baseline"))))
    contract = splits.split_contract(frozen, YEAR_SPLIT, "all", mae, "boosted_poisson")
    return contract.select(
        "segment", F.size("features").alias("feature_count"), F.col("features")[0].alias("first_feature"),
        "station_pool", "train_years", "val_years", "test_years", rounded(F.col("baseline_val_mae")).alias("baseline_val_mae"))


@query("unseen_cells", with_ctes("""
    , occurred AS (SELECT station_id, hour, dayofweek(start_date) + 1 AS weekday, year, count(*) AS n
        FROM departures GROUP BY ALL)
    SELECT count(DISTINCT (station_id, hour, weekday)) AS unseen_cells, CAST(coalesce(sum(n), 0) AS BIGINT) AS unseen_rows
    FROM occurred t WHERE year > 1995 AND NOT EXISTS (SELECT 1 FROM occurred s WHERE s.year = 1995
        AND s.station_id = t.station_id AND s.hour = t.hour AND s.weekday = t.weekday)""", "departures"))
def unseen_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells that saw a departure after the first year but none in it."""
    seen = pool.departures(ordered_trips(spark, folder)).withColumn("weekday", F.dayofweek("start_date"))
    trained = baseline.fit_cells(seen.where("year = 1995").withColumn(TARGET, F.lit(1)), {})
    return baseline.unseen_cells(seen.where("year > 1995"), trained)


@query("lookup_hour_weekday", with_ctes("""
    SELECT concat_ws('|', station_id, hour, weekday) AS key, round(avg(trip_count), 6) AS value
    FROM cal_panel WHERE year = 2000 GROUP BY station_id, hour, weekday""", "cal_panel"))
def lookup_hour_weekday(spark: SparkSession, folder: str) -> DataFrame:
    """Written as JSON and read back, as the service does."""
    return _lookup(spark, folder, 0)


@query("lookup_month", with_ctes("""
    SELECT concat_ws('|', station_id, month) AS key, round(avg(trip_count), 6) AS value
    FROM cal_panel WHERE year = 2000 GROUP BY station_id, month""", "cal_panel"))
def lookup_month(spark: SparkSession, folder: str) -> DataFrame:
    return _lookup(spark, folder, 1)


def _lookup(spark: SparkSession, folder: str, which: int) -> DataFrame:
    history = year_calendar(spark, folder).where("year = 2000")
    path = scratch_path(spark, "lookup")
    records.write_lookup(requests.prior_lookups(history)[which], path)
    return records.read_lookup(spark, path)


@query("service_stations", with_ctes("""
    SELECT station_id, trim(regexp_replace(station_name, '\\s+', ' ', 'g')) AS station_name, 2000 AS history_year,
        2001 AS target_year FROM pool""", "pool"))
def service_stations(spark: SparkSession, folder: str) -> DataFrame:
    return requests.service_stations(year_pool(spark, folder), suppliers(spark, folder), 2000)


@query("quantile_cells", with_ctes("""
    SELECT station_id, hour, weekday, round(quantile_cont(trip_count, 0.5), 6) AS q50,
        round(quantile_cont(trip_count, 0.8), 6) AS q80, round(quantile_cont(trip_count, 0.9), 6) AS q90
    FROM ev_cal_panel GROUP BY ALL""", "ev_cal_panel"))
def quantile_cells(spark: SparkSession, folder: str) -> DataFrame:
    models = {f"q{int(q * 100)}": rounded(baseline.quantile_of(q)) for q in (0.5, 0.8, 0.9)}
    return baseline.fit_cells(event_panel(spark, folder), models).select(*CELL_KEYS, *models)


@query("busiest_station_week", with_ctes("""
    SELECT station_id, start_date, hour, trip_count FROM ev_panel
    WHERE station_id = (SELECT station_id FROM ev_panel GROUP BY 1 ORDER BY sum(trip_count) DESC, 1 LIMIT 1)
        AND start_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'""", "ev_panel"))
def busiest_station_week(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.busiest_slice(event_counts(spark, folder), "2024-01-08", "2024-01-14")
