"""The station pool: busy in some year and open for the whole span."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidewheel.contract import POOL_TOP_N
from tidewheel.operators.profile import duration_in_range


def departures(fact: DataFrame) -> DataFrame:
    """(station_id, start_date, hour, year) of trips with a plausible duration."""
    return fact.where(duration_in_range()).select(
        F.col("fact_trip_start_station_id").alias("station_id"),
        F.col("fact_trip_start_date_id").alias("start_date"),
        F.col("fact_trip_start_hour").alias("hour"), F.col("start_year").alias("year"))


def segment(fact: DataFrame, dim_user_type: DataFrame, name: str, years: list[int]) -> DataFrame:
    """Departures of one user type in the given years.

    The year filter stays on the partition column, so only those folders are read.
    """
    chosen = dim_user_type.where(F.col("dim_user_type_name") == name).select(
        F.col("dim_user_type_id").alias("fact_trip_user_type_id"))
    return departures(fact.where(F.col("start_year").isin(years))
                      .join(chosen, "fact_trip_user_type_id", "left_semi"))


def yearly_activity(daily: DataFrame) -> DataFrame:
    """Trips, first and last day per station and year, from `panel.daily_counts`."""
    trips = F.aggregate("by_hour", F.lit(0).cast("bigint"), lambda total, n: total + n)
    return daily.groupBy("station_id", F.year("start_date").alias("year")).agg(
        F.sum(trips).alias("trips"), F.min("start_date").alias("first_trip"),
        F.max("start_date").alias("last_trip"))


def lifespan(activity: DataFrame) -> DataFrame:
    return activity.groupBy("station_id").agg(
        F.min("first_trip").alias("first_trip"), F.max("last_trip").alias("last_trip"))


def top_n_per(counts: DataFrame, group: str, key: str, value: str, n: int) -> DataFrame:
    """Rank rows of a pre-aggregated frame per group; ties go to the smaller key."""
    order = Window.partitionBy(group).orderBy(F.desc(value), key)
    return counts.withColumn("rnk", F.row_number().over(order)).where(F.col("rnk") <= n)


def station_pool(activity: DataFrame, dim_station: DataFrame, first_by: str, last_from: str,
                 n: int = POOL_TOP_N) -> DataFrame:
    """Stations among the top `n` of a year and active by `first_by` and from `last_from` on."""
    ranks = top_n_per(activity, "year", "station_id", "trips", n).groupBy("station_id").agg(
        F.count_distinct("year").alias("top_years"), F.min("rnk").alias("best_rank"))
    spanning = lifespan(activity).where((F.col("first_trip") <= F.to_date(F.lit(first_by)))
                                        & (F.col("last_trip") >= F.to_date(F.lit(last_from))))
    names = dim_station.select(F.col("dim_station_id").alias("station_id"),
                               F.col("dim_station_name").alias("station_name"))
    return (spanning.join(ranks, "station_id").join(names, "station_id", "left")
            .select("station_id", "station_name", "first_trip", "last_trip", "top_years", "best_rank")
            .orderBy("best_rank", "station_id"))


def keep_pool(trips: DataFrame, pool: DataFrame) -> DataFrame:
    """Trips that start at a pool station.

    The pool is read from files, so Catalyst broadcasts it by its real size.
    """
    return trips.join(pool.select("station_id"), "station_id", "left_semi")


def pool_flag(trips: DataFrame, pool: DataFrame) -> DataFrame:
    """All trips with a boolean `in_pool`, for accounting in one scan."""
    marks = pool.select("station_id").withColumn("in_pool", F.lit(True))
    return trips.join(marks, "station_id", "left").withColumn(
        "in_pool", F.coalesce("in_pool", F.lit(False)))


def cleaned_trips(fact: DataFrame, pool: DataFrame) -> DataFrame:
    """The narrow projection of trips that pass the duration and pool filters."""
    narrow = fact.where(duration_in_range()).select(
        F.col("fact_trip_id").alias("trip_id"), F.col("fact_trip_start_station_id").alias("station_id"),
        F.col("fact_trip_start_date_id").alias("start_date"), F.col("fact_trip_start_hour").alias("hour"),
        F.col("fact_trip_duration").alias("duration"), F.col("start_year").alias("year"))
    return keep_pool(narrow, pool).select("trip_id", "station_id", "start_date", "hour", "duration", "year")


def pool_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sizes of two pools, their intersection and the two differences."""
    sides = a.select("station_id", F.lit(True).alias("in_a")).join(
        b.select("station_id", F.lit(True).alias("in_b")), "station_id", "full_outer")
    in_a, in_b = F.col("in_a").isNotNull(), F.col("in_b").isNotNull()
    return sides.agg(F.count_if(in_a).alias("pool_a"), F.count_if(in_b).alias("pool_b"),
                     F.count_if(in_a & in_b).alias("shared"), F.count_if(in_a & ~in_b).alias("only_a"),
                     F.count_if(in_b & ~in_a).alias("only_b"))
