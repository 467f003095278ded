"""Profiling, station pool, cleaned trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.functions.encoding import rounded
from tidewheel.operators import panel, pool, profile
from tidewheel.queries.check_sql import with_ctes
from tidewheel.queries.registry import query
from tidewheel.queries.standins import event_trips, ordered_trips, priorities, suppliers, year_pool
from tidewheel.session import materialize, scratch_path
from tidewheel.sources import exports, tables

SEGMENT_YEARS = [1996, 1997, 1998, 1999]
QUANTILES = {"p01": 0.01, "p50": 0.5, "p99": 0.99, "p999": 0.999}


@query("calendar_coverage", with_ctes("""
    SELECT min(fact_trip_start_date_id) AS min_date, max(fact_trip_start_date_id) AS max_date,
        count(DISTINCT fact_trip_start_date_id) AS distinct_days, count(DISTINCT fact_trip_start_hour) AS distinct_hours,
        date_diff('day', min(fact_trip_start_date_id), max(fact_trip_start_date_id)) + 1 AS span_days,
        date_diff('day', min(fact_trip_start_date_id), max(fact_trip_start_date_id)) + 1
            - count(DISTINCT fact_trip_start_date_id) AS missing_days
    FROM trips""", "trips"))
def calendar_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return profile.coverage(ordered_trips(spark, folder))


@query("calendar_gaps", with_ctes("""
    SELECT CAST(min(d) AS DATE) AS gap_start, CAST(max(d) AS DATE) AS gap_end, CAST(count(*) AS INT) AS days FROM (
        SELECT d, d - CAST(row_number() OVER (ORDER BY d) AS INT) AS run
        FROM (SELECT dim_date_id AS d FROM cal
              WHERE dim_date_id < (SELECT max(fact_trip_start_date_id) FROM trips)
              EXCEPT SELECT fact_trip_start_date_id FROM trips))
    GROUP BY run""", "trips", "cal"))
def calendar_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return profile.gap_runs(ordered_trips(spark, folder))


def _quantiles_check(source: str) -> str:
    return with_ctes(f"""
    SELECT unnest(['p_min', 'p01', 'p50', 'p99', 'p999', 'p_max', 'below_minimum', 'above_maximum']) AS measure,
        unnest([CAST(min(fact_trip_duration) AS DOUBLE), round(quantile_cont(fact_trip_duration, 0.01), 6),
            round(quantile_cont(fact_trip_duration, 0.5), 6), round(quantile_cont(fact_trip_duration, 0.99), 6),
            round(quantile_cont(fact_trip_duration, 0.999), 6), CAST(max(fact_trip_duration) AS DOUBLE),
            CAST(count(*) FILTER (fact_trip_duration < 60) AS DOUBLE),
            CAST(count(*) FILTER (fact_trip_duration > 86400) AS DOUBLE)]) AS value
    FROM {source}""", source)


@query("duration_quantiles", _quantiles_check("trips"))
def duration_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    return profile.duration_quantiles(ordered_trips(spark, folder), QUANTILES).withColumn("value", rounded(F.col("value")))


@query("event_duration_quantiles", _quantiles_check("ev_trips"))
def event_duration_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    return profile.duration_quantiles(event_trips(spark, folder), QUANTILES).withColumn("value", rounded(F.col("value")))


@query("duration_filter", with_ctes("""
    SELECT fact_trip_source_id, fact_trip_duration FROM trips WHERE fact_trip_duration BETWEEN 60 AND 86400""", "trips"))
def duration_filter(spark: SparkSession, folder: str) -> DataFrame:
    return ordered_trips(spark, folder).where(profile.duration_in_range()).select(
        "fact_trip_source_id", "fact_trip_duration")


@query("segment_trips", with_ctes("""
    SELECT fact_trip_start_station_id AS station_id, fact_trip_start_date_id AS start_date,
        fact_trip_start_hour AS hour, start_year AS year
    FROM trips WHERE fact_trip_duration BETWEEN 60 AND 86400 AND fact_trip_user_type_id = 1
        AND start_year BETWEEN 1996 AND 1999""", "trips"))
def segment_trips(spark: SparkSession, folder: str) -> DataFrame:
    return pool.segment(ordered_trips(spark, folder), priorities(spark, folder), "1-URGENT", SEGMENT_YEARS)


@query("station_lifespan", with_ctes("""
    SELECT station_id, min(start_date) AS first_trip, max(start_date) AS last_trip
    FROM departures GROUP BY 1""", "departures"))
def station_lifespan(spark: SparkSession, folder: str) -> DataFrame:
    return pool.lifespan(pool.yearly_activity(panel.daily_counts(pool.departures(ordered_trips(spark, folder)))))


@query("top_n_per_year", with_ctes("""
    SELECT year, station_id, trips, CAST(rnk AS INT) AS rnk FROM ranked WHERE rnk <= 50""", "ranked"))
def top_n_per_year(spark: SparkSession, folder: str) -> DataFrame:
    activity = pool.yearly_activity(panel.daily_counts(pool.departures(ordered_trips(spark, folder))))
    return pool.top_n_per(activity, "year", "station_id", "trips", 50).select("year", "station_id", "trips", "rnk")


@query("station_pool", with_ctes("""
    SELECT station_id, station_name, first_trip, last_trip, top_years, CAST(best_rank AS INT) AS best_rank
    FROM pool""", "pool"))
def station_pool(spark: SparkSession, folder: str) -> DataFrame:
    return year_pool(spark, folder)


@query("pool_overlap", with_ctes("""
    , seg AS (SELECT * FROM departures_of_one WHERE year BETWEEN 1996 AND 1999),
    seg_ranked AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY n DESC, station_id) AS rnk
        FROM (SELECT station_id, year, count(*) AS n FROM seg GROUP BY ALL)),
    seg_pool AS (SELECT station_id FROM seg_ranked GROUP BY 1 HAVING min(rnk) <= 10),
    all_pool AS (SELECT station_id FROM ranked GROUP BY 1 HAVING min(rnk) <= 10)
    SELECT count(a.station_id) AS pool_a, count(b.station_id) AS pool_b,
        count(*) FILTER (a.station_id IS NOT NULL AND b.station_id IS NOT NULL) AS shared,
        count(*) FILTER (b.station_id IS NULL) AS only_a, count(*) FILTER (a.station_id IS NULL) AS only_b
    FROM all_pool a FULL JOIN seg_pool b ON a.station_id = b.station_id""".replace("departures_of_one", """(
        SELECT fact_trip_start_station_id AS station_id, start_year AS year FROM trips
        WHERE fact_trip_duration BETWEEN 60 AND 86400 AND fact_trip_user_type_id = 1)"""), "ranked"))
def pool_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Top ten of any year: all users against one user type."""
    fact = ordered_trips(spark, folder)
    urgent = pool.segment(fact, priorities(spark, folder), "1-URGENT", SEGMENT_YEARS)
    pools = [pool.station_pool(materialize(pool.yearly_activity(panel.daily_counts(trips)), "activity"),
                               suppliers(spark, folder), "9999-12-31", "0001-01-01", n=10)
             for trips in (pool.departures(fact), urgent)]
    return pool.pool_overlap(*pools)


@query("filter_funnel", with_ctes("""
    , steps AS (SELECT count(*) AS raw, count(*) FILTER (ok) AS after_duration,
        count(*) FILTER (ok AND station IN (SELECT station_id FROM pool)) AS after_pool
        FROM (SELECT fact_trip_duration BETWEEN 60 AND 86400 AS ok, fact_trip_start_station_id AS station FROM trips))
    SELECT unnest(['raw', 'after_duration', 'after_pool']) AS step,
        unnest([raw, after_duration, after_pool]) AS row_count,
        unnest([round(100.0 * raw / raw, 4), round(100.0 * after_duration / raw, 4),
                round(100.0 * after_pool / raw, 4)]) AS pct FROM steps""", "trips", "pool"))
def filter_funnel(spark: SparkSession, folder: str) -> DataFrame:
    trips = ordered_trips(spark, folder).withColumnRenamed("fact_trip_start_station_id", "station_id")
    flagged = pool.pool_flag(trips, year_pool(spark, folder))
    steps = {"after_duration": profile.duration_in_range(), "after_pool": F.col("in_pool")}
    return profile.funnel(flagged, steps).withColumn("pct", F.round("pct", 4))


CLEANED_SQL = """
    SELECT fact_trip_id AS trip_id, fact_trip_start_station_id AS station_id, fact_trip_start_date_id AS start_date,
        fact_trip_start_hour AS hour, fact_trip_duration AS duration, start_year AS year
    FROM trips WHERE fact_trip_duration BETWEEN 60 AND 86400
        AND fact_trip_start_station_id IN (SELECT station_id FROM pool)"""


def write_cleaned(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    kept = pool.cleaned_trips(ordered_trips(spark, folder), year_pool(spark, folder))
    path = scratch_path(spark, "cleaned")
    tables.write_partitioned(kept, path, ["year"])
    return kept, tables.read_table(spark, path)


@query("cleaned_trips", with_ctes(CLEANED_SQL, "trips", "pool"))
def cleaned_trips(spark: SparkSession, folder: str) -> DataFrame:
    return write_cleaned(spark, folder)[1].select("trip_id", "station_id", "start_date", "hour", "duration", "year")


@query("readback_reconcile", with_ctes(f"""
    SELECT year, count(*) AS written_row_count, count(*) AS read_row_count,
        count(DISTINCT station_id) AS written_stations, count(DISTINCT station_id) AS read_stations,
        min(start_date) AS written_from_date, min(start_date) AS read_from_date,
        max(start_date) AS written_to_date, max(start_date) AS read_to_date, 'ok' AS status
    FROM ({CLEANED_SQL}) GROUP BY year""", "trips", "pool"))
def readback_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    written, found = write_cleaned(spark, folder)
    return exports.reconcile_groups(written, found, ["year"], {
        "row_count": F.count("*"), "stations": F.count_distinct("station_id"),
        "from_date": F.min("start_date"), "to_date": F.max("start_date")})
