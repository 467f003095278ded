"""Stage queries: CSV in, partitions, cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.contract import RAW_HEADERS, STAGE_COLUMNS, STAGE_PARTITIONS, STAGE_SCHEMA
from tidewheel.functions import text
from tidewheel.operators import cleaning, dimensions, quality
from tidewheel.queries.check_sql import with_ctes
from tidewheel.queries.registry import query
from tidewheel.queries.standins import clean_stage, raw_stage
from tidewheel.session import scratch_path
from tidewheel.sources import csvs, tables

# An empty CSV field is a null.


def csv_folders(spark: SparkSession, folder: str, with_model: bool = False) -> dict[str, str]:
    """Write the raw stage as one CSV folder per source year, with its original headers.

    The first header carries a byte order mark, as the published files do. The files are compressed; a file holds the
    rows of one task and year, so reading them is as parallel as writing.
    """
    stage = raw_stage(spark, folder)
    root = scratch_path(spark, "csv")
    headers = [F.col(c).alias(("﻿" if i == 0 else "") + h) for i, (h, c) in enumerate(RAW_HEADERS.items())]
    extra = [F.col("model").alias("model")] if with_model else [F.col("model").alias("Bike Model")]
    (stage.select(*headers, *extra, "source_year").write.partitionBy("source_year")
     .option("header", True).option("compression", "lz4")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(root))
    # what was written names the years: no second join of all lines for a few values
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    years = sorted(f.getPath().getName().partition("=")[2] for f in found if f.isDirectory())
    return {year: f"{root}/source_year={year}/*.csv.lz4" for year in years}


@query("csv_extract", with_ctes(f"""
    SELECT trip_id, trip_duration, start_time, start_station_id, start_station_name, end_time, end_station_id,
        end_station_name, nullif(bike_id, '') AS bike_id, user_type, CAST(NULL AS VARCHAR) AS model, source_year FROM raw""", "raw"))
def csv_extract(spark: SparkSession, folder: str) -> DataFrame:
    return csvs.read_years(spark, csv_folders(spark, folder))


@query("header_normalise", with_ctes("""
    SELECT * FROM (
        SELECT unnest(['Trip Id', 'Trip  Duration', 'Start Time', 'Start Station Id', 'Start Station Name', 'End Time',
                       'End Station Id', 'End Station Name', 'Bike Id', 'User Type']) AS header,
            unnest(['trip_id', 'trip_duration', 'start_time', 'start_station_id', 'start_station_name', 'end_time',
                    'end_station_id', 'end_station_name', 'bike_id', 'user_type']) AS column_name,
            unnest([count(trip_id), count(trip_duration), count(start_time), count(start_station_id),
                    count(start_station_name), count(end_time), count(end_station_id), count(end_station_name),
                    count(nullif(bike_id, '')), count(user_type)]) AS filled
        FROM raw)""", "raw"))
def header_normalise(spark: SparkSession, folder: str) -> DataFrame:
    stage = csvs.read_years(spark, csv_folders(spark, folder))
    tall = stage.agg(*[F.count(c).alias(c) for c in RAW_HEADERS.values()]).unpivot(
        [], list(RAW_HEADERS.values()), "column_name", "filled")
    header = F.create_map(*[F.lit(x) for h, c in RAW_HEADERS.items() for x in (c, h)])[F.col("column_name")]
    return tall.select(header.alias("header"), "column_name", "filled")


@query("schema_align", with_ctes("""
    SELECT source_year, source, count(*) AS row_count, count(model) AS with_model, count(trip_id) AS with_trip_id
    FROM (SELECT *, 'with model' AS source FROM raw UNION ALL
          SELECT * REPLACE (CAST(NULL AS VARCHAR) AS model), 'without model' AS source FROM raw)
    GROUP BY ALL""", "raw"))
def schema_align(spark: SparkSession, folder: str) -> DataFrame:
    having = csvs.read_years(spark, csv_folders(spark, folder, with_model=True))
    lacking = csvs.read_years(spark, csv_folders(spark, folder))
    both = having.withColumn("source", F.lit("with model")).unionByName(
        lacking.withColumn("source", F.lit("without model")))
    return both.groupBy("source_year", "source").agg(
        F.count("*").alias("row_count"), F.count("model").alias("with_model"), F.count("trip_id").alias("with_trip_id"))


@query("raw_line_reconcile", with_ctes("""
    SELECT source_year, count(*) AS raw_lines, count(*) AS staged_rows, 'ok' AS status FROM raw GROUP BY 1""", "raw"))
def raw_line_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    folders = csv_folders(spark, folder)
    return csvs.reconcile_lines(csvs.raw_line_counts(spark, folders), csvs.read_years(spark, folders))


def _stage_table(spark: SparkSession, stage: DataFrame) -> tuple[str, str]:
    location = scratch_path(spark, "stage_trips")
    name = location.rsplit("/", 1)[1].replace("-", "_")
    tables.create_versioned(spark, name, STAGE_SCHEMA, location, STAGE_PARTITIONS)
    tables.write_partitioned(stage, location, STAGE_PARTITIONS, dynamic=True)
    tables.register_partitions(spark, name)
    return name, location


@query("stage_schema", with_ctes("""
    SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]) AS position,
        unnest(['trip_id', 'trip_duration', 'start_time', 'start_station_id', 'start_station_name', 'end_time',
                'end_station_id', 'end_station_name', 'bike_id', 'user_type', 'model', 'source_year']) AS column_name,
        'string' AS column_type,
        unnest([count(trip_id), count(trip_duration), count(start_time), count(start_station_id),
                count(start_station_name), count(end_time), count(end_station_id), count(end_station_name),
                count(bike_id), count(user_type), count(model), count(source_year)]) AS filled
    FROM raw""", "raw"))
def stage_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Create and load the stage table, then describe it through the catalog."""
    name, _ = _stage_table(spark, raw_stage(spark, folder))
    loaded = spark.table(name)
    filled = loaded.agg(*[F.count(c).alias(c) for c in loaded.columns]).unpivot(
        [], loaded.columns, "column_name", "filled")
    return tables.schema_table(loaded).join(filled, "column_name")


@query("partition_overwrite", with_ctes("""
    SELECT source_year, count(*) AS row_count, count(*) FILTER (ok) AS valid_rows
    FROM judged WHERE source_year <> '2001' OR ok GROUP BY 1""", "judged"))
def partition_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """Load all years, then replace one year by its valid rows; the others must stay."""
    stage = raw_stage(spark, folder)
    name, location = _stage_table(spark, stage)
    last = stage.where("source_year = '2001'")
    tables.write_partitioned(cleaning.valid_rows(last), location, STAGE_PARTITIONS, dynamic=True)
    spark.sql(f"REFRESH TABLE {name}")
    return spark.table(name).groupBy(F.col("source_year")).agg(
        F.count("*").alias("row_count"), F.count_if(cleaning.is_valid()).alias("valid_rows"))


@query("clean_in_place", with_ctes("""
    SELECT source_year, count(*) AS row_count, count(DISTINCT user_type) AS user_types FROM stage GROUP BY 1""", "stage"))
def clean_in_place(spark: SparkSession, folder: str) -> DataFrame:
    """Replace the stage table by its own cleaned rows."""
    name, _ = _stage_table(spark, raw_stage(spark, folder))
    tables.swap_table(cleaning.clean(spark.table(name)), name, STAGE_PARTITIONS)
    return spark.table(name).groupBy("source_year").agg(
        F.count("*").alias("row_count"), F.count_distinct("user_type").alias("user_types"))


@query("valid_trips", with_ctes("SELECT * EXCLUDE (ok) FROM judged WHERE ok", "judged"))
def valid_trips(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.valid_rows(raw_stage(spark, folder))


@query("clean_audit", with_ctes("""
    SELECT count(*) AS before_rows, count(*) FILTER (NOT ok) AS dropped_rows, count(*) FILTER (ok) AS after_rows
    FROM judged""", "judged"))
def clean_audit(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_audit(raw_stage(spark, folder))


@query("clean_stage", with_ctes("SELECT * FROM stage", "stage"))
def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean_stage(spark, folder)


@query("repair_end_time", with_ctes("""
    SELECT trip_id, trip_duration, start_time, end_time FROM stage""", "stage"))
def repair_end_time(spark: SparkSession, folder: str) -> DataFrame:
    return clean_stage(spark, folder).select("trip_id", "trip_duration", "start_time", "end_time")


@query("clean_names", with_ctes("""
    SELECT name, count(*) AS row_count FROM (
        SELECT start_station_name AS name FROM stage UNION ALL SELECT end_station_name FROM stage)
    GROUP BY 1""", "stage"))
def clean_names(spark: SparkSession, folder: str) -> DataFrame:
    names = F.array(text.clean_name("start_station_name"), text.clean_name("end_station_name"))
    return cleaning.valid_rows(raw_stage(spark, folder)).select(F.explode(names).alias("name")).groupBy("name").agg(
        F.count("*").alias("row_count"))


@query("normalise_user_type", with_ctes("""
    SELECT coalesce(user_type, '(null)') AS raw_value,
        CASE trim(replace(coalesce(user_type, ''), chr(13), '')) WHEN 'Annual Member' THEN 'annual'
             WHEN 'Casual Member' THEN 'casual' WHEN '' THEN 'UNKNOWN'
             ELSE trim(replace(user_type, chr(13), '')) END AS cleaned, count(*) AS row_count
    FROM raw GROUP BY ALL""", "raw"))
def normalise_user_type(spark: SparkSession, folder: str) -> DataFrame:
    return raw_stage(spark, folder).groupBy(
        F.coalesce("user_type", F.lit("(null)")).alias("raw_value"), text.clean_user_type().alias("cleaned")).agg(
        F.count("*").alias("row_count"))


@query("default_bike_id", with_ctes("SELECT bike_id, count(*) AS row_count FROM stage GROUP BY 1", "stage"))
def default_bike_id(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.valid_rows(raw_stage(spark, folder)).groupBy(text.clean_bike().alias("bike_id")).agg(
        F.count("*").alias("row_count"))


@query("default_model", with_ctes("SELECT model, count(*) AS row_count FROM stage GROUP BY 1", "stage"))
def default_model(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.valid_rows(raw_stage(spark, folder)).groupBy(text.clean_model().alias("model")).agg(
        F.count("*").alias("row_count"))


_STAGE_CHECK = """
    SELECT '{source}' AS source, unnest(['trip_id not int', 'duration <= 0', 'start_time malformed', 'end_time malformed',
            'start_station_id not int', 'end_station_id not int', 'literal ''NULL'' name', 'start_time unparseable',
            'trip_id null', 'trip_duration null', 'start_time null', 'start_station_id null', 'start_station_name null',
            'end_time null', 'end_station_id null', 'end_station_name null', 'bike_id null', 'user_type null',
            'model null', 'source_year null']) AS "check",
        unnest([count(*) FILTER (NOT regexp_matches(trip_id, '^[0-9]+$')),
            count(*) FILTER (TRY_CAST(trip_duration AS DOUBLE) <= 0),
            count(*) FILTER (NOT regexp_matches(start_time, '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}} [0-9]{{2}}:[0-9]{{2}}$')),
            count(*) FILTER (NOT regexp_matches(end_time, '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}} [0-9]{{2}}:[0-9]{{2}}$')),
            count(*) FILTER (NOT regexp_matches(start_station_id, '^[0-9]+$')),
            count(*) FILTER (NOT regexp_matches(end_station_id, '^[0-9]+$')),
            count(*) FILTER (start_station_name = 'NULL' OR end_station_name = 'NULL'),
            count(*) FILTER (try_strptime(start_time, '%m/%d/%Y %H:%M') IS NULL),
            count(*) - count(trip_id), count(*) - count(trip_duration), count(*) - count(start_time),
            count(*) - count(start_station_id), count(*) - count(start_station_name), count(*) - count(end_time),
            count(*) - count(end_station_id), count(*) - count(end_station_name), count(*) - count(bike_id),
            count(*) - count(user_type), count(*) - count(model), count(*) - count(source_year)]) AS violations
    FROM {source}"""


@query("dq_stage", with_ctes(f"""
    SELECT *, CASE WHEN violations = 0 THEN 'ok' ELSE 'FAIL' END AS status
    FROM ({_STAGE_CHECK.format(source='raw')} UNION ALL {_STAGE_CHECK.format(source='stage')})""", "raw", "stage"))
def dq_stage(spark: SparkSession, folder: str) -> DataFrame:
    reports = [quality.stage_checks(df).withColumn("source", F.lit(name))
               for name, df in (("raw", raw_stage(spark, folder)), ("stage", clean_stage(spark, folder)))]
    return reports[0].unionByName(reports[1])


@query("null_profile", with_ctes("""
    SELECT unnest(['trip_id', 'trip_duration', 'start_time', 'start_station_id', 'start_station_name', 'end_time',
                'end_station_id', 'end_station_name', 'bike_id', 'user_type', 'model', 'source_year']) AS column_name,
        unnest([count(*) - count(trip_id), count(*) - count(trip_duration), count(*) - count(start_time),
            count(*) - count(start_station_id), count(*) - count(start_station_name), count(*) - count(end_time),
            count(*) - count(end_station_id), count(*) - count(end_station_name), count(*) - count(bike_id),
            count(*) - count(user_type), count(*) - count(model), count(*) - count(source_year)]) AS nulls,
        round(nulls / count(*), 6) AS share
    FROM raw""", "raw"))
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_profile(raw_stage(spark, folder)).withColumn("share", F.round("share", 6))


@query("date_bounds", with_ctes("""
    SELECT min(CAST(strptime(start_time, '%m/%d/%Y %H:%M') AS DATE)) AS first_date,
        max(CAST(strptime(end_time, '%m/%d/%Y %H:%M') AS DATE)) AS last_date FROM stage""", "stage"))
def date_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.date_bounds(clean_stage(spark, folder))


@query("value_counts", with_ctes("SELECT user_type AS value, count(*) AS row_count FROM stage GROUP BY 1", "stage"))
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.value_counts(clean_stage(spark, folder), "user_type")


@query("month_histogram", with_ctes("""
    SELECT CAST(month(strptime(start_time, '%m/%d/%Y %H:%M')) AS INT) AS month, count(*) AS row_count
    FROM stage GROUP BY 1""", "stage"))
def month_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return quality.month_histogram(clean_stage(spark, folder))
