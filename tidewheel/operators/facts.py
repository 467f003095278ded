"""The trip fact table and the star queries over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewheel.contract import star_schema
from tidewheel.functions.encoding import rounded
from tidewheel.functions.stamps import parse_stamp
from tidewheel.operators.numbering import with_dense_id


def fact_typed(stage: DataFrame) -> DataFrame:
    """Typed fact measures of the cleaned stage; `user_type` is still a name."""
    measures = {
        "fact_trip_source_id": F.col("trip_id").try_cast("bigint"),
        "fact_trip_duration": F.col("trip_duration").try_cast("double").try_cast("int"),
        "fact_trip_start_station_id": F.col("start_station_id").try_cast("int"),
        "fact_trip_end_station_id": F.col("end_station_id").try_cast("int"),
        "fact_trip_bike_id": F.col("bike_id").try_cast("int"),
        "user_type": F.col("user_type"),
    }
    parsed = stage.select(parse_stamp("start_time").alias("fact_trip_start_ts"),
                          parse_stamp("end_time").alias("fact_trip_end_ts"),
                          *[m.alias(n) for n, m in measures.items()])
    clock = {}
    for end in ("start", "end"):
        stamp = F.col(f"fact_trip_{end}_ts")
        clock[f"fact_trip_{end}_date_id"] = F.to_date(stamp)
        clock[f"fact_trip_{end}_hour"] = F.hour(stamp)
        clock[f"fact_trip_{end}_minute"] = F.minute(stamp)
    start = F.col("fact_trip_start_ts")
    return parsed.withColumns({**clock, "start_year": F.year(start), "start_month": F.month(start)})


def resolve_key(fact: DataFrame, dim: DataFrame, name: str, dim_name: str, dim_key: str, key: str) -> DataFrame:
    """Replace the text column `name` by the surrogate key found in `dim`.

    There is no broadcast hint: `dim` is a table on disk, so Catalyst broadcasts it when
    its files are below the threshold and AQE splits hot names when they are not.
    """
    lookup = dim.select(F.col(dim_name).alias(name), F.col(dim_key).alias(key))
    return fact.join(lookup, name).drop(name)


def build_fact(stage: DataFrame, dim_user_type: DataFrame) -> DataFrame:
    """The fact table in its published column order, numbered 1..n by source id."""
    resolved = resolve_key(fact_typed(stage), dim_user_type, "user_type", "dim_user_type_name",
                           "dim_user_type_id", "fact_trip_user_type_id")
    numbered = with_dense_id(resolved, ["fact_trip_source_id"], "fact_trip_id")
    return numbered.select(*star_schema("fact_trip").names)


def season_by_user_type(fact: DataFrame, dim_date: DataFrame, dim_user_type: DataFrame) -> DataFrame:
    """Trips and average minutes per season and user type.

    The fact is reduced to one row per (day, user type) first; the dimension joins then
    work on that small frame and the fact is never shuffled row by row.
    """
    daily = fact.groupBy("fact_trip_start_date_id", "fact_trip_user_type_id").agg(
        F.count("*").alias("n"), F.sum("fact_trip_duration").alias("seconds"),
        F.count("fact_trip_duration").alias("timed"))
    joined = (daily.join(dim_date, F.col("fact_trip_start_date_id") == F.col("dim_date_id"))
              .join(dim_user_type, F.col("fact_trip_user_type_id") == F.col("dim_user_type_id")))
    return (joined.groupBy("dim_date_season", "dim_user_type_name")
            .agg(F.sum("n").alias("trips"),
                 rounded(F.try_divide(F.sum("seconds"), F.sum("timed")) / 60, 1).alias("avg_min"))
            .orderBy("dim_date_season", "dim_user_type_name"))


def top_stations_by_name(fact: DataFrame, dim_station: DataFrame, k: int = 5) -> DataFrame:
    """The k station names with most departures; ties go to the smaller name."""
    per_station = fact.groupBy("fact_trip_start_station_id").agg(F.count("*").alias("n"))
    return (per_station.join(dim_station, F.col("fact_trip_start_station_id") == F.col("dim_station_id"))
            .groupBy("dim_station_name").agg(F.sum("n").alias("trips"))
            .orderBy(F.desc("trips"), "dim_station_name").limit(k))
