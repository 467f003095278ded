"""Dimensions of the star schema, derived from the cleaned stage."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.contract import UNKNOWN
from tidewheel.functions.calendar import calendar_columns
from tidewheel.functions.stamps import parse_stamp
from tidewheel.operators.numbering import with_dense_id


def date_bounds(stage: DataFrame) -> DataFrame:
    """First start date and last end date in the stage."""
    return stage.agg(F.min(parse_stamp("start_time")).cast("date").alias("first_date"),
                     F.max(parse_stamp("end_time")).cast("date").alias("last_date"))


def dim_date(bounds: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row per calendar day of a one-row (first_date, last_date) frame.

    Days nobody rode are included. `holidays` is data: one `holiday` date per row.
    """
    days = bounds.select(
        F.explode(F.sequence("first_date", "last_date", F.expr("interval 1 day"))).alias("dim_date_id"))
    parts = calendar_columns(F.col("dim_date_id"))
    marked = holidays.select(F.col("holiday").alias("dim_date_id")).distinct()
    marked = marked.withColumn("dim_date_is_holiday", F.lit(True))
    # at most one row per calendar day on either side of this join
    return days.join(F.broadcast(marked), "dim_date_id", "left").select(
        "dim_date_id",
        *[parts[p].alias(f"dim_date_{p}") for p in ("year", "quarter", "month", "day", "week", "weekday")],
        parts["is_weekend"].alias("dim_date_is_weekend"),
        F.coalesce("dim_date_is_holiday", F.lit(False)).alias("dim_date_is_holiday"),
        parts["season"].alias("dim_date_season"))


def calendar_between(spark: SparkSession, first: datetime.date, last: datetime.date,
                     holidays: DataFrame) -> DataFrame:
    bounds = spark.range(1).select(F.lit(first).alias("first_date"), F.lit(last).alias("last_date"))
    return dim_date(bounds, holidays)


def station_sightings(stage: DataFrame) -> DataFrame:
    """(station_id, station_name, seen_at) for both ends of each trip, in one scan."""
    ends = [F.struct(F.col(f"{end}_station_id").try_cast("int").alias("station_id"),
                     F.col(f"{end}_station_name").alias("station_name"),
                     parse_stamp(f"{end}_time").alias("seen_at"))
            for end in ("start", "end")]
    return (stage.select(F.inline(F.array(*ends)))
            .where(F.col("station_id").isNotNull() & F.col("station_name").isNotNull()))


def dim_station(sightings: DataFrame) -> DataFrame:
    """Latest name per station; the placeholder only wins where no other name exists.

    The first step is a hash aggregate on (id, name), so a hot station shrinks to one
    row per name before anything is shuffled; ties go to the greater name.
    """
    last_seen = sightings.groupBy("station_id", "station_name").agg(F.max("seen_at").alias("seen_at"))
    recency = F.struct(F.col("station_name") != UNKNOWN, F.col("seen_at"), F.col("station_name"))
    return last_seen.groupBy(F.col("station_id").alias("dim_station_id")).agg(
        F.max_by("station_name", recency).alias("dim_station_name"))


def dim_bike(stage: DataFrame) -> DataFrame:
    """One row per bike with its model; UNKNOWN only where no trip names a model."""
    pairs = (stage.select(F.col("bike_id").try_cast("int").alias("dim_bike_id"),
                          F.nullif(F.col("model"), F.lit(UNKNOWN)).alias("model"))
             .where("dim_bike_id is not null").distinct())
    return pairs.groupBy("dim_bike_id").agg(
        F.coalesce(F.max("model"), F.lit(UNKNOWN)).alias("dim_bike_model"))


def dim_user_type(stage: DataFrame) -> DataFrame:
    """User types numbered 1..n by name."""
    names = stage.select(F.col("user_type").alias("dim_user_type_name")).where(
        "dim_user_type_name is not null").distinct()
    return with_dense_id(names, ["dim_user_type_name"], "dim_user_type_id").select(
        F.col("dim_user_type_id").cast("int").alias("dim_user_type_id"), "dim_user_type_name")
