"""The data contract: names, formats and constants every module agrees on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values ----------------------------------------------------------
# Text that has to match the source files and published tables exactly.

STAMP_FORMAT = "MM/dd/yyyy HH:mm"
STAMP_PATTERN = r"^[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}$"
INTEGER_PATTERN = r"^[0-9]+$"
NUMBER_PATTERN = r"^[0-9]+(\.[0-9]+)?$"
UNKNOWN = "UNKNOWN"

# CSV header -> stage column; the duration header really has two spaces.
RAW_HEADERS = {
    "Trip Id": "trip_id",
    "Trip  Duration": "trip_duration",
    "Start Time": "start_time",
    "Start Station Id": "start_station_id",
    "Start Station Name": "start_station_name",
    "End Time": "end_time",
    "End Station Id": "end_station_id",
    "End Station Name": "end_station_name",
    "Bike Id": "bike_id",
    "User Type": "user_type",
}
OPTIONAL_COLUMNS = ["model"]
USER_TYPE_LABELS = {"Annual Member": "annual", "Casual Member": "casual"}

# Columns of the star schema. Source ids are BIGINT so that they cannot
# overflow on large networks.
STAR_COLUMNS = {
    "dim_date": "dim_date_id DATE, dim_date_year INT, dim_date_quarter INT, "
    "dim_date_month INT, dim_date_day INT, dim_date_week INT, dim_date_weekday INT, "
    "dim_date_is_weekend BOOLEAN, dim_date_is_holiday BOOLEAN, dim_date_season STRING",
    "dim_station": "dim_station_id INT, dim_station_name STRING",
    "dim_bike": "dim_bike_id INT, dim_bike_model STRING",
    "dim_user_type": "dim_user_type_id INT, dim_user_type_name STRING",
    "fact_trip": "fact_trip_id BIGINT, fact_trip_source_id BIGINT, fact_trip_duration INT, "
    "fact_trip_start_ts TIMESTAMP_NTZ, fact_trip_end_ts TIMESTAMP_NTZ, "
    "fact_trip_start_date_id DATE, fact_trip_end_date_id DATE, "
    "fact_trip_start_hour INT, fact_trip_start_minute INT, "
    "fact_trip_end_hour INT, fact_trip_end_minute INT, "
    "fact_trip_start_station_id INT, fact_trip_end_station_id INT, "
    "fact_trip_bike_id INT, fact_trip_user_type_id INT, start_year INT, start_month INT",
}
STAR_PARTITIONS = {"fact_trip": ["start_year", "start_month"]}

MIN_DURATION, MAX_DURATION = 60, 86400
POOL_TOP_N = 50

TARGET = "trip_count"
CALENDAR_FEATURES = [
    "station_id", "season", "hour", "quarter", "month", "weekday", "week_of_year",
    "is_weekend", "is_holiday", "hour_sin", "hour_cos", "weekday_sin", "weekday_cos",
    "month_sin", "month_cos",
]
PRIOR_FEATURES = ["py_station_hour_weekday_mean", "py_station_month_mean"]
CATEGORICAL_FEATURES = ["station_id", "season"]
BANNED_FEATURES = ["year", "start_date", TARGET]
CELL_KEYS = ["station_id", "hour", "weekday"]
CYCLES = {"hour": 24, "weekday": 7, "month": 12}
PEAK_HOURS = [7, 8, 9, 16, 17, 18, 19]
BUSY_THRESHOLD = 11
# (label, upper edge); each band excludes its lower edge and includes its upper one.
DEMAND_BANDS = [("0", 0), ("1-2", 2), ("3-5", 5), ("6-10", 10), ("11+", None)]

# Holidays the forecasting service knows, in date order.
SERVICE_HOLIDAYS = [
    "2019-01-01", "2019-02-18", "2019-04-19", "2019-05-20", "2019-07-01", "2019-09-02",
    "2019-10-14", "2019-12-25", "2019-12-26",
    "2020-01-01", "2020-02-17", "2020-04-10", "2020-05-18", "2020-07-01", "2020-09-07",
    "2020-10-12", "2020-12-25", "2020-12-26",
    "2021-01-01", "2021-02-15", "2021-04-02", "2021-05-24", "2021-07-01", "2021-09-06",
    "2021-10-11", "2021-12-25", "2021-12-26", "2021-12-27", "2021-12-28",
    "2022-01-01", "2022-01-03", "2022-02-21", "2022-04-15", "2022-05-23", "2022-07-01",
    "2022-09-05", "2022-10-10", "2022-12-25", "2022-12-26",
    "2023-01-01", "2023-01-02", "2023-02-20", "2023-04-07", "2023-05-22", "2023-07-01",
    "2023-09-04", "2023-10-09", "2023-12-25", "2023-12-26",
]

# Fits as published: the default model, the candidates of the sweep, and what the shipped model is trained with.
BOOST_DEFAULT = {"learning_rate": 0.1, "max_leaf_nodes": 31, "rounds": 300}
BOOST_GRID = [
    {"learning_rate": 0.1, "max_leaf_nodes": 31, "rounds": 300},
    {"learning_rate": 0.1, "max_leaf_nodes": 63, "rounds": 300},
    {"learning_rate": 0.1, "max_leaf_nodes": 127, "rounds": 300},
    {"learning_rate": 0.05, "max_leaf_nodes": 63, "rounds": 600},
    {"learning_rate": 0.05, "max_leaf_nodes": 127, "rounds": 600},
    {"learning_rate": 0.05, "max_leaf_nodes": 127, "rounds": 600, "min_samples_leaf": 100},
    {"learning_rate": 0.05, "max_leaf_nodes": 127, "rounds": 600, "l2": 1.0},
    {"learning_rate": 0.05, "max_leaf_nodes": 127, "rounds": 600, "max_features": 0.7},
]
BOOST_SHIPPED = {"learning_rate": 0.05, "max_leaf_nodes": 127, "rounds": 600, "max_features": 0.7, "quantile": 0.8}
# --- End of fixed values ---------------------------------------------------

STAGE_COLUMNS = [*RAW_HEADERS.values(), *OPTIONAL_COLUMNS]
STAGE_PARTITIONS = ["source_year"]
STAGE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in STAGE_COLUMNS + STAGE_PARTITIONS])


def star_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(STAR_COLUMNS[table])
