"""The checks of the other modules on data with seeded faults: what they have to find is counted in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.contract import CELL_KEYS, PRIOR_FEATURES, STAR_COLUMNS, TARGET
from tidewheel.operators import features, panel, pool, requests, splits
from tidewheel.queries import prep, stage, warehouse
from tidewheel.queries.check_sql import with_ctes
from tidewheel.queries.registry import query
from tidewheel.queries.standins import (YEAR_SPLIT, event_panel, ordered_trips, raw_stage, with_holidays, year_calendar,
                                        year_days, year_features, year_pool)
from tidewheel.session import materialize, scratch_path
from tidewheel.sources import csvs, exports, tables


@query("feature_parity_faults", with_ctes("""
    , base AS (SELECT *, station_id * 24 + hour + dayofyear(start_date) AS k FROM ev_panel),
    f AS (SELECT count(*) FILTER (k % 97 = 0) AS lost, count(*) FILTER (k % 97 <> 0 AND k % 13 = 1) AS season,
              count(*) FILTER (k % 97 <> 0 AND k % 17 = 2) AS holiday, count(*) FILTER (k % 97 <> 0 AND k % 19 = 3) AS week,
              count(*) FILTER (k % 97 <> 0 AND k % 23 = 4) AS wave FROM base)
    SELECT unnest(['unpaired rows', 'season', 'quarter', 'month', 'weekday', 'week_of_year', 'is_weekend', 'is_holiday',
            'hour_sin', 'hour_cos', 'weekday_sin', 'weekday_cos', 'month_sin', 'month_cos']) AS "check",
        unnest([lost, season, 0, 0, 0, week, 0, holiday, wave, 0, 0, 0, 0, 0])::BIGINT AS violations,
        unnest([CASE WHEN x > 0 THEN 'FAIL' ELSE 'ok' END FOR x IN
            [lost, season, 0, 0, 0, week, 0, holiday, wave, 0, 0, 0, 0, 0]]) AS status FROM f""", "ev_panel"))
def feature_parity_faults(spark: SparkSession, folder: str) -> DataFrame:
    """The service's features against a stored panel whose calendar was loaded as a table, and then damaged."""
    counts = event_panel(spark, folder)
    bounds = counts.agg(F.min("start_date").alias("first_date"), F.max("start_date").alias("last_date"))
    path = scratch_path(spark, "dim_date")
    tables.write_small(with_holidays(bounds), path)
    loaded = tables.read_table(spark, path)
    keys = ["station_id", "start_date", "hour"]
    stored = features.add_cyclical(features.add_calendar(counts.select(*keys, TARGET), loaded))
    k = F.col("station_id") * 24 + F.col("hour") + F.dayofyear("start_date")
    damaged = stored.where(k % 97 != 0).withColumns({
        "season": F.when(k % 13 == 1, "dry").otherwise(F.col("season")),
        "is_holiday": F.when(k % 17 == 2, 1 - F.col("is_holiday").cast("int")).otherwise(F.col("is_holiday").cast("int")),
        "week_of_year": F.when(k % 19 != 3, F.col("week_of_year")),
        "hour_sin": F.when(k % 23 == 4, F.col("hour_sin") + 0.001).otherwise(F.col("hour_sin"))})
    holidays = loaded.where("dim_date_is_holiday").select(F.col("dim_date_id").alias("holiday"))
    derived = ["season", "quarter", "month", "weekday", "week_of_year", "is_weekend", "is_holiday", "hour_sin",
               "hour_cos", "weekday_sin", "weekday_cos", "month_sin", "month_cos"]
    return features.parity(requests.derived_features(counts.select(*keys), holidays), damaged, keys, derived)


@query("prior_year_faults", with_ctes("""
    , hourly AS (SELECT station_id, hour, weekday, year, avg(trip_count) AS m FROM cal_panel GROUP BY ALL),
    monthly AS (SELECT station_id, month, year, avg(trip_count) AS m FROM cal_panel GROUP BY ALL),
    found AS (
        SELECT 'py_station_hour_weekday_mean' AS feature, count(*) AS cells, count(*) FILTER (
            CASE WHEN b.m IS NULL THEN a.hour = 5 ELSE a.hour IN (3, 5) OR (a.hour = 4 AND a.station_id % 2 = 0) END) AS violations
        FROM hourly a LEFT JOIN hourly b ON b.station_id = a.station_id AND b.hour = a.hour AND b.weekday = a.weekday
            AND b.year = a.year - 1
        UNION ALL
        SELECT 'py_station_month_mean', count(*), 0 FROM monthly)
    SELECT feature, cells, violations::BIGINT AS violations, CASE WHEN violations > 0 THEN 'FAIL' ELSE 'ok' END AS status
    FROM found""", "cal_panel"))
def prior_year_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Means that are off in one hour, missing in another for half of the stations, and invented in a third."""
    name = PRIOR_FEATURES[0]
    mean = F.col(name)
    wrong = (F.when(F.col("hour") == 3, mean + 0.5).when((F.col("hour") == 4) & (F.col("station_id") % 2 == 0), None)
             .when(F.col("hour") == 5, F.lit(-3.0)).otherwise(mean))
    return features.prior_year_checks(year_features(spark, folder).withColumn(name, wrong))


@query("raw_line_faults", with_ctes("""
    SELECT source_year, count(*) AS raw_lines, nullif(count(*) FILTER (source_year <> '1997'
               AND NOT coalesce(source_year = '1996' AND bike_id = '7', false)), 0) AS staged_rows,
        CASE WHEN source_year = '1997' OR bool_or(coalesce(source_year = '1996' AND bike_id = '7', false)) THEN 'FAIL'
             ELSE 'ok' END AS status
    FROM raw GROUP BY 1""", "raw"))
def raw_line_faults(spark: SparkSession, folder: str) -> DataFrame:
    """A stage that lost a year, and a vehicle of another one."""
    folders = stage.csv_folders(spark, folder)
    staged = csvs.read_years(spark, folders).where("source_year <> '1997'").where(
        ~F.coalesce((F.col("source_year") == "1996") & (F.col("bike_id") == "7"), F.lit(False)))
    return csvs.reconcile_lines(csvs.raw_line_counts(spark, folders), staged)


@query("manifest_faults", with_ctes(f"""
    , kept AS (SELECT table_name, row_count, CASE table_name
            WHEN 'dim_station' THEN (SELECT count(*) FROM dim_station WHERE dim_station_id % 2 = 0)
            WHEN 'dim_bike' THEN 2 * row_count ELSE row_count END AS found_rows FROM ({warehouse.ROWS_SQL}))
    SELECT *, CASE WHEN found_rows = row_count THEN 'ok' ELSE 'FAIL' END AS status FROM kept""", *warehouse.ALL_TABLES))
def manifest_faults(spark: SparkSession, folder: str) -> DataFrame:
    """An export of which one table lost rows and another was written twice."""
    path = scratch_path(spark, "export")
    recorded = exports.export_tables(warehouse.star_tables(spark, folder), path)
    found = exports.read_export(spark, path, list(STAR_COLUMNS))
    found["dim_station"] = found["dim_station"].where("dim_station_id % 2 = 0")
    found["dim_bike"] = found["dim_bike"].unionByName(found["dim_bike"])
    return exports.reconcile(found, recorded).select("table_name", "row_count", "found_rows", "status")


@query("readback_faults", with_ctes(f"""
    , w AS ({prep.CLEANED_SQL}), r AS (SELECT * FROM w WHERE year <> 1998 AND NOT (year = 1999 AND hour = 3)
             UNION ALL SELECT * FROM w WHERE year = 2000 AND hour = 4),
    a AS (SELECT year, count(*) AS n, sum(hour)::BIGINT AS h FROM w GROUP BY 1),
    b AS (SELECT year, count(*) AS n, sum(hour)::BIGINT AS h FROM r GROUP BY 1)
    SELECT year, a.n AS written_row_count, b.n AS read_row_count, a.h AS written_hours, b.h AS read_hours,
        CASE WHEN a.n IS NOT DISTINCT FROM b.n AND a.h IS NOT DISTINCT FROM b.h THEN 'ok' ELSE 'FAIL' END AS status
    FROM a FULL JOIN b USING (year)""", "trips", "pool"))
def readback_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Files that lack a year and an hour of another, and hold an hour twice."""
    written, found = prep.write_cleaned(spark, folder)
    damaged = found.where("year <> 1998 AND NOT (year = 1999 AND hour = 3)").unionByName(found.where("year = 2000 AND hour = 4"))
    return exports.reconcile_groups(written, damaged, ["year"], {"row_count": F.count("*"), "hours": F.sum("hour")})


@query("panel_faults", with_ctes("""
    , lost AS (SELECT coalesce(sum(trip_count), 0) AS trips, count(*) AS n FROM panel WHERE hour = 7 AND station_id % 3 = 0),
    twice AS (SELECT coalesce(sum(trip_count), 0) AS trips, count(*) AS n FROM panel WHERE hour = 9),
    f AS (SELECT abs(twice.trips - lost.trips)::BIGINT AS trips, twice.n AS grain, abs(twice.n - lost.n) AS enriched FROM lost, twice)
    SELECT unnest(['trip total changed', 'duplicate station-hours', 'rows changed by enrichment']) AS "check",
        unnest([trips, grain, enriched]) AS violations,
        unnest([CASE WHEN x > 0 THEN 'FAIL' ELSE 'ok' END FOR x IN [trips, grain, enriched]]) AS status FROM f""", "panel"))
def panel_faults(spark: SparkSession, folder: str) -> DataFrame:
    """A panel that lacks an hour of some stations and has another hour twice."""
    enriched = materialize(year_calendar(spark, folder), "panel")
    counts = enriched.select("station_id", "start_date", "hour", TARGET)
    damaged = counts.where("NOT (hour = 7 AND station_id % 3 = 0)").unionByName(counts.where("hour = 9"))
    trips = pool.keep_pool(pool.departures(ordered_trips(spark, folder)), year_pool(spark, folder))
    return panel.panel_checks(damaged, trips, enriched)


@query("split_faults", with_ctes("""
    , moved AS (SELECT trip_count, start_date, CASE WHEN hour = 6 AND split = 'val' THEN 'train'
                    WHEN hour = 8 THEN NULL ELSE split END AS split FROM ysplit),
    f AS (SELECT (max(start_date) FILTER (split = 'train') >= min(start_date) FILTER (split = 'val'))::BIGINT AS first,
              (max(start_date) FILTER (split = 'val') >= min(start_date) FILTER (split = 'test'))::BIGINT AS second,
              ((SELECT sum(trip_count) FROM panel) - sum(trip_count) FILTER (split IS NOT NULL))::BIGINT AS lost FROM moved)
    SELECT unnest(['train/val overlap', 'val/test overlap', 'target sum changed']) AS "check",
        unnest([first, second, lost]) AS violations,
        unnest([CASE WHEN x > 0 THEN 'FAIL' ELSE 'ok' END FOR x IN [first, second, lost]]) AS status FROM f""", "ysplit"))
def split_faults(spark: SparkSession, folder: str) -> DataFrame:
    """A split with hours of validation among the training rows, and without another hour."""
    days = year_days(spark, folder)
    split = splits.split_by_period(panel.unfold(days), YEAR_SPLIT, features=CELL_KEYS).where("hour <> 8").withColumn(
        "split", F.when((F.col("hour") == 6) & (F.col("split") == "val"), "train").otherwise(F.col("split")))
    return splits.split_checks(materialize(split, "split"), panel.unfold(days), list(YEAR_SPLIT))
