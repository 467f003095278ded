"""Warehouse queries: dimensions, fact, star joins, export, expectation suites."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.contract import STAR_COLUMNS, STAR_PARTITIONS
from tidewheel.operators import dimensions, facts, quality
from tidewheel.queries.check_sql import with_ctes
from tidewheel.queries.registry import query
from tidewheel.queries.standins import (calendar, clean_stage, event_kinds, event_trips, ordered_trips, priorities, read,
                                        suppliers, with_holidays)
from tidewheel.session import materialize, scratch_path
from tidewheel.sources import exports, tables


def star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five star tables, built from the raw stage.

    The cleaned stage feeds six tables, so it is written once and read six times.
    """
    stage = materialize(clean_stage(spark, folder), "stage")
    kinds = materialize(dimensions.dim_user_type(stage), "dim_user_type")
    return {
        "stage": stage,
        "dim_date": with_holidays(dimensions.date_bounds(stage)),
        "dim_station": dimensions.dim_station(dimensions.station_sightings(stage)),
        "dim_bike": dimensions.dim_bike(stage),
        "dim_user_type": kinds,
        "fact_trip": facts.build_fact(stage, kinds),
    }


def star_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: df for name, df in star(spark, folder).items() if name != "stage"}


def export_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The star tables for an export, which reads each to write it and to count it: dimensions are built once."""
    return {name: materialize(df, name) if name in ("dim_date", "dim_station", "dim_bike") else df
            for name, df in star_tables(spark, folder).items()}


@query("dim_date", with_ctes("SELECT * FROM dim_date", "dim_date"))
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return with_holidays(dimensions.date_bounds(clean_stage(spark, folder)))


@query("holiday_flag", with_ctes("""
    SELECT dim_date_id AS holiday, dim_date_weekday AS weekday, dim_date_season AS season
    FROM dim_date WHERE dim_date_is_holiday""", "dim_date"))
def holiday_flag(spark: SparkSession, folder: str) -> DataFrame:
    return dim_date(spark, folder).where("dim_date_is_holiday").select(
        F.col("dim_date_id").alias("holiday"), F.col("dim_date_weekday").alias("weekday"),
        F.col("dim_date_season").alias("season"))


@query("holidays_per_year", with_ctes("""
    SELECT dim_date_year, count(*) FILTER (dim_date_is_holiday) AS holidays,
        count(*) FILTER (dim_date_is_weekend) AS weekend_days, count(*) AS days
    FROM dim_date GROUP BY 1""", "dim_date"))
def holidays_per_year(spark: SparkSession, folder: str) -> DataFrame:
    return quality.holidays_per_year(dim_date(spark, folder))


@query("station_sightings", with_ctes("SELECT * FROM sightings", "sightings"))
def station_sightings(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.station_sightings(clean_stage(spark, folder))


@query("stations_used", with_ctes("SELECT DISTINCT station_id FROM sightings", "sightings"))
def stations_used(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.station_sightings(clean_stage(spark, folder)).select("station_id").distinct()


@query("dim_station", with_ctes("SELECT * FROM dim_station", "dim_station"))
def dim_station(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_station(dimensions.station_sightings(clean_stage(spark, folder))).orderBy("dim_station_id")


@query("dim_bike", with_ctes("SELECT * FROM dim_bike", "dim_bike"))
def dim_bike(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_bike(clean_stage(spark, folder)).orderBy("dim_bike_id")


@query("dim_user_type", with_ctes("SELECT * FROM dim_user_type", "dim_user_type"))
def dim_user_type(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_user_type(clean_stage(spark, folder))


@query("fact_typed", with_ctes("SELECT * FROM typed", "typed"))
def fact_typed(spark: SparkSession, folder: str) -> DataFrame:
    return facts.fact_typed(clean_stage(spark, folder))


@query("resolve_user_type", with_ctes("""
    SELECT fact_trip_source_id, fact_trip_start_ts, dim_user_type_id AS fact_trip_user_type_id
    FROM typed JOIN dim_user_type ON user_type = dim_user_type_name""", "typed", "dim_user_type"))
def resolve_user_type(spark: SparkSession, folder: str) -> DataFrame:
    stage = clean_stage(spark, folder)
    typed = facts.fact_typed(stage).select("fact_trip_source_id", "fact_trip_start_ts", "user_type")
    return facts.resolve_key(typed, dimensions.dim_user_type(stage), "user_type", "dim_user_type_name",
                             "dim_user_type_id", "fact_trip_user_type_id")


# Rows that share a source id may take each other's number, so only the numbers and the
# source ids they were given to are compared.
@query("fact_surrogate_key", with_ctes("SELECT fact_trip_id, fact_trip_source_id FROM fact", "fact"))
def fact_surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder)["fact_trip"].select("fact_trip_id", "fact_trip_source_id")


@query("fact_trip", with_ctes("SELECT * EXCLUDE (fact_trip_id) FROM fact", "fact"))
def fact_trip(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder)["fact_trip"].drop("fact_trip_id")


@query("fact_partition_counts", with_ctes("""
    SELECT start_year, start_month, count(*) AS row_count FROM fact GROUP BY ALL""", "fact"))
def fact_partition_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Write the fact partitioned by year and month and count what a reader finds."""
    path = scratch_path(spark, "fact_trip")
    tables.write_partitioned(star(spark, folder)["fact_trip"], path, STAR_PARTITIONS["fact_trip"])
    return quality.rows_per(tables.read_table(spark, path), "start_year", "start_month")


def _type(ddl: str) -> str:
    return ddl.lower()


@cache
def _star_schema_check() -> str:
    parts = []
    for table, ddl in STAR_COLUMNS.items():
        fields = [c.split() for c in ddl.split(", ")]
        names = ", ".join(f"'{n}'" for n, _ in fields)
        types = ", ".join(f"'{_type(t)}'" for _, t in fields)
        counts = ", ".join(f"count({n})" for n, _ in fields)
        source = "fact" if table == "fact_trip" else table
        parts.append(f"SELECT '{table}' AS table_name, CAST(unnest(range(1, {len(fields) + 1})) AS INT) AS position, "
                     f"unnest([{names}]) AS column_name, unnest([{types}]) AS column_type, "
                     f"unnest([{counts}]) AS filled FROM {source}")
    return with_ctes(" UNION ALL ".join(parts), "fact", "dim_date", "dim_station", "dim_bike", "dim_user_type")


@query("star_schema", _star_schema_check())
def star_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Create the five catalog tables, load them, describe and profile them."""
    location = scratch_path(spark, "star")
    prefix = location.rsplit("/", 1)[1].replace("-", "_") + "_"
    names = tables.create_star(spark, location, prefix)
    for table, df in star_tables(spark, folder).items():
        if STAR_PARTITIONS.get(table):
            tables.write_partitioned(df, f"{location}/{table}", STAR_PARTITIONS[table])
            tables.register_partitions(spark, prefix + table)
        else:
            tables.write_small(df, f"{location}/{table}")
            spark.sql(f"REFRESH TABLE {prefix}{table}")
    described = tables.describe_tables(spark, names)
    filled = None
    for name in names:
        loaded = spark.table(name)
        counts = loaded.agg(*[F.count(c).alias(c) for c in loaded.columns]).unpivot(
            [], loaded.columns, "column_name", "filled").withColumn("table_name", F.lit(name))
        filled = counts if filled is None else filled.unionByName(counts)
    return described.join(filled, ["table_name", "column_name"]).withColumn(
        "table_name", F.replace("table_name", F.lit(prefix), F.lit("")))


ROWS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, {len(ddl.split(', '))} AS column_count, "
    f"'{','.join(STAR_PARTITIONS.get(t, []))}' AS partitioned_by FROM {'fact' if t == 'fact_trip' else t}"
    for t, ddl in STAR_COLUMNS.items())
ALL_TABLES = ("fact", "dim_date", "dim_station", "dim_bike", "dim_user_type")


@query("export_manifest", with_ctes(ROWS_SQL, *ALL_TABLES))
def export_manifest(spark: SparkSession, folder: str) -> DataFrame:
    recorded = exports.export_tables(export_sources(spark, folder), scratch_path(spark, "export"))
    return recorded.drop("exported_at", "spark_version")


@query("manifest_reconcile", with_ctes(
    f"SELECT table_name, row_count, row_count AS found_rows, 'ok' AS status FROM ({ROWS_SQL})", *ALL_TABLES))
def manifest_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """Export, read back from the files alone, and compare with the manifest."""
    path = scratch_path(spark, "export")
    recorded = exports.export_tables(export_sources(spark, folder), path)
    found = exports.read_export(spark, path, list(STAR_COLUMNS))
    return exports.reconcile(found, recorded).select("table_name", "row_count", "found_rows", "status")


@query("star_join_season", with_ctes("""
    SELECT dim_date_season, o_orderpriority AS dim_user_type_name, count(*) AS trips,
        round(avg(fact_trip_duration) / 60, 1) AS avg_min
    FROM trips JOIN cal ON fact_trip_start_date_id = dim_date_id
    JOIN (SELECT DISTINCT o_orderpriority FROM orders) ON CAST(o_orderpriority[1] AS INT) = fact_trip_user_type_id
    GROUP BY ALL""", "trips", "cal"))
def star_join_season(spark: SparkSession, folder: str) -> DataFrame:
    fact = ordered_trips(spark, folder)
    return facts.season_by_user_type(fact, calendar(fact), priorities(spark, folder))


@query("event_star_join", with_ctes("""
    SELECT dim_date_season, event_type AS dim_user_type_name, count(*) AS trips,
        round(avg(fact_trip_duration) / 60, 1) AS avg_min
    FROM ev_trips JOIN ev_cal ON fact_trip_start_date_id = dim_date_id
    JOIN (SELECT DISTINCT event_type FROM events)
      ON list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) = fact_trip_user_type_id
    GROUP BY ALL""", "ev_trips", "ev_cal"))
def event_star_join(spark: SparkSession, folder: str) -> DataFrame:
    fact = event_trips(spark, folder)
    return facts.season_by_user_type(fact, calendar(fact), event_kinds(spark, folder))


@query("top_stations_by_name", with_ctes("""
    SELECT s_name AS dim_station_name, count(*) AS trips
    FROM trips JOIN supplier ON s_suppkey = fact_trip_start_station_id
    GROUP BY 1 ORDER BY trips DESC, 1 LIMIT 5""", "trips"))
def top_stations_by_name(spark: SparkSession, folder: str) -> DataFrame:
    return facts.top_stations_by_name(ordered_trips(spark, folder), suppliers(spark, folder))


def _standin_dims(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Dimensions that do not cover every key: stations are the suppliers only."""
    fact = ordered_trips(spark, folder)
    return {
        "dim_date": calendar(fact), "dim_station": suppliers(spark, folder),
        "dim_bike": read(spark, folder, "part").select(F.col("p_partkey").cast("int").alias("dim_bike_id")),
        "dim_user_type": priorities(spark, folder)}


@query("orphan_keys", with_ctes("""
    SELECT *, CASE WHEN violations = 0 THEN 'ok' ELSE 'FAIL' END AS status FROM (
        SELECT unnest(['fact_trip_start_date_id', 'fact_trip_end_date_id', 'fact_trip_start_station_id',
                       'fact_trip_end_station_id', 'fact_trip_bike_id', 'fact_trip_user_type_id']) AS foreign_key,
            unnest(['dim_date', 'dim_date', 'dim_station', 'dim_station', 'dim_bike', 'dim_user_type']) AS dimension,
            unnest([count(*) FILTER (fact_trip_start_date_id NOT IN (SELECT dim_date_id FROM cal)),
                count(*) FILTER (fact_trip_end_date_id NOT IN (SELECT dim_date_id FROM cal)),
                count(*) FILTER (fact_trip_start_station_id NOT IN (SELECT s_suppkey FROM supplier)),
                count(*) FILTER (fact_trip_end_station_id NOT IN (SELECT s_suppkey FROM supplier)),
                count(*) FILTER (fact_trip_bike_id NOT IN (SELECT p_partkey FROM part)),
                count(*) FILTER (fact_trip_user_type_id NOT IN
                    (SELECT CAST(o_orderpriority[1] AS INT) FROM orders))]) AS violations
        FROM trips)""", "trips", "cal"))
def orphan_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.orphans(ordered_trips(spark, folder), quality.star_links(_standin_dims(spark, folder)))


@query("referential_integrity", with_ctes("""
    SELECT unnest(['dim_stations', 'active_stations', 'orphan_stations', 'orphan_dates']) AS measure,
        unnest([(SELECT count(*) FROM supplier), count(DISTINCT fact_trip_end_station_id),
            count(DISTINCT fact_trip_end_station_id) FILTER (fact_trip_end_station_id NOT IN
                (SELECT s_suppkey FROM supplier)),
            count(DISTINCT fact_trip_start_date_id) FILTER (fact_trip_start_date_id NOT IN
                (SELECT dim_date_id FROM cal))]) AS value
    FROM trips""", "trips", "cal"))
def referential_integrity(spark: SparkSession, folder: str) -> DataFrame:
    """Checked on arrivals, whose stations the dimension covers only in part."""
    fact = ordered_trips(spark, folder)
    arrivals = fact.select(F.col("fact_trip_end_station_id").alias("fact_trip_start_station_id"),
                           "fact_trip_start_date_id")
    return quality.referential_integrity(arrivals, suppliers(spark, folder), calendar(fact))


@query("duplicate_keys", with_ctes("""
    SELECT 'fact_trip_source_id' AS key_column, count(*) AS row_count,
        count(DISTINCT fact_trip_source_id) AS distinct_keys,
        count(*) - count(DISTINCT fact_trip_source_id) AS duplicates FROM trips""", "trips"))
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicates(ordered_trips(spark, folder), "fact_trip_source_id")


@query("rows_per_year", with_ctes("SELECT start_year, count(*) AS row_count FROM trips GROUP BY 1", "trips"))
def rows_per_year(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rows_per(ordered_trips(spark, folder), "start_year")


@query("key_profile", with_ctes("""
    SELECT unnest(['total', 'null_start_station_id', 'null_start_time', 'null_duration', 'null_model',
                   'distinct_ids']) AS measure,
        unnest([count(*), count(*) - count(start_station_id), count(*) - count(start_time),
                count(*) - count(trip_duration), count(*) - count(model), count(DISTINCT trip_id)]) AS value
    FROM raw""", "raw"))
def key_profile(spark: SparkSession, folder: str) -> DataFrame:
    from tidewheel.queries.standins import raw_stage
    stage = raw_stage(spark, folder).withColumnRenamed("trip_duration", "duration")
    return quality.key_profile(stage, ["start_station_id", "start_time", "duration", "model"], "trip_id")


@query("dq_dim_date", with_ctes("""
    SELECT *, CASE WHEN violations = 0 THEN 'ok' ELSE 'FAIL' END AS status FROM (
        SELECT unnest(['gaps', 'duplicates', 'quarter not 1-4', 'month not 1-12', 'day not 1-31', 'week not 1-53',
                       'weekday not 1-7', 'year not 1995-2000', 'season invalid', 'weekday mismatch',
                       'weekend mismatch']) AS "check",
            unnest([date_diff('day', min(dim_date_id), max(dim_date_id)) + 1 - count(DISTINCT dim_date_id),
                count(*) - count(DISTINCT dim_date_id),
                count(*) FILTER (dim_date_quarter NOT BETWEEN 1 AND 4),
                count(*) FILTER (dim_date_month NOT BETWEEN 1 AND 12),
                count(*) FILTER (dim_date_day NOT BETWEEN 1 AND 31),
                count(*) FILTER (dim_date_week NOT BETWEEN 1 AND 53),
                count(*) FILTER (dim_date_weekday NOT BETWEEN 1 AND 7),
                count(*) FILTER (dim_date_year NOT BETWEEN 1995 AND 2000),
                count(*) FILTER (dim_date_season NOT IN ('winter', 'spring', 'summer', 'fall')),
                count(*) FILTER (dayofweek(dim_date_id) + 1 <> dim_date_weekday),
                count(*) FILTER (dim_date_is_weekend <> (dim_date_weekday IN (1, 7)))]) AS violations
        FROM dim_date)""", "dim_date"))
def dq_dim_date(spark: SparkSession, folder: str) -> DataFrame:
    """The accepted years end before the data does, so that one check has to fail."""
    return quality.dim_date_checks(dim_date(spark, folder), 1995, 2000)


@query("dq_dims", with_ctes("""
    SELECT *, CASE WHEN violations = 0 THEN 'ok' ELSE 'FAIL' END AS status FROM (
        SELECT unnest(['dim_station duplicate keys', 'dim_station null keys']) AS "check",
            unnest([count(*) - count(DISTINCT dim_station_id), count(*) - count(dim_station_id)]) AS violations
        FROM dim_station
        UNION ALL SELECT 'dim_station missing stage keys', count(*) FROM
            (SELECT DISTINCT station_id FROM sightings) WHERE station_id NOT IN (SELECT dim_station_id FROM dim_station)
        UNION ALL SELECT unnest(['dim_bike duplicate keys', 'dim_bike null keys']),
            unnest([count(*) - count(DISTINCT dim_bike_id), count(*) - count(dim_bike_id)]) FROM dim_bike
        UNION ALL SELECT 'dim_bike missing stage keys', count(*) FROM
            (SELECT DISTINCT CAST(bike_id AS INT) AS id FROM stage) WHERE id NOT IN (SELECT dim_bike_id FROM dim_bike)
        UNION ALL SELECT unnest(['dim_user_type duplicate keys', 'dim_user_type null keys']),
            unnest([count(*) - count(DISTINCT dim_user_type_id), count(*) - count(dim_user_type_id)]) FROM dim_user_type
        UNION ALL SELECT 'dim_user_type missing stage keys', count(DISTINCT user_type) FROM stage
            WHERE user_type NOT IN (SELECT dim_user_type_name FROM dim_user_type))""",
    "dim_station", "dim_bike", "dim_user_type"))
def dq_dims(spark: SparkSession, folder: str) -> DataFrame:
    built = star(spark, folder)
    stage, kinds = built["stage"], built["dim_user_type"]
    stations, bikes = (materialize(built[name], name) for name in ("dim_station", "dim_bike"))
    used_kinds = stage.select("user_type").distinct().join(
        kinds.withColumnRenamed("dim_user_type_name", "user_type"), "user_type", "left")
    return (quality.dimension_checks(stations, "dim_station_id",
                                     dimensions.station_sightings(stage), "station_id")
            .unionByName(quality.dimension_checks(bikes, "dim_bike_id", stage.select(
                F.col("bike_id").try_cast("int").alias("bike_id")), "bike_id"))
            .unionByName(quality.dimension_checks(kinds, "dim_user_type_id", used_kinds.select(
                F.col("dim_user_type_id").alias("user_type_id")), "user_type_id")))


_FACT_COLUMNS = [c.split()[0] for c in STAR_COLUMNS["fact_trip"].split(", ")]


@query("dq_fact", with_ctes(f"""
    SELECT *, CASE WHEN violations = 0 THEN 'ok' ELSE 'FAIL' END AS status FROM (
        SELECT unnest(['duration <= 0', 'start_hour not 0-23', 'start_minute not 0-59', 'end_hour not 0-23',
                'end_minute not 0-59', 'end before start', 'date_id != ts date', 'duplicate fact_trip_id',
                'duplicate fact_trip_source_id', 'rows lost from stage',
                {', '.join(f"'{c} null'" for c in _FACT_COLUMNS)}]) AS "check",
            unnest([count(*) FILTER (fact_trip_duration <= 0),
                count(*) FILTER (fact_trip_start_hour NOT BETWEEN 0 AND 23),
                count(*) FILTER (fact_trip_start_minute NOT BETWEEN 0 AND 59),
                count(*) FILTER (fact_trip_end_hour NOT BETWEEN 0 AND 23),
                count(*) FILTER (fact_trip_end_minute NOT BETWEEN 0 AND 59),
                count(*) FILTER (fact_trip_end_ts < fact_trip_start_ts),
                count(*) FILTER (CAST(fact_trip_start_ts AS DATE) <> fact_trip_start_date_id),
                count(*) - count(DISTINCT fact_trip_id), count(*) - count(DISTINCT fact_trip_source_id),
                abs((SELECT count(*) FROM stage) - count(*)),
                {', '.join(f'count(*) - count({c})' for c in _FACT_COLUMNS)}]) AS violations
        FROM fact)""", "fact"))
def dq_fact(spark: SparkSession, folder: str) -> DataFrame:
    built = star(spark, folder)
    return quality.fact_checks(built["fact_trip"], built["stage"])
