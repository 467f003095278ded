"""The zero-filled station x day x hour panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewheel.operators.quality import count_checks
from tidewheel.session import spread

HOURS = range(24)


def hourly_counts(trips: DataFrame) -> DataFrame:
    """Departures per station, day and hour that occurred."""
    return trips.groupBy("station_id", "start_date", "hour").agg(F.count("*").alias("trip_count"))


def daily_counts(trips: DataFrame) -> DataFrame:
    """(station_id, start_date, by_hour): 24 departure counters per station and day.

    The only pass over the trips. Its result has one row per active station and day, so
    the pool, the observed days and the panel can all be read from it; write it once
    with `materialize` when several of them are needed.
    """
    counters = F.array(*[F.count_if(F.col("hour") == h) for h in HOURS])
    return trips.where("start_date is not null").groupBy("station_id", "start_date").agg(counters.alias("by_hour"))


def station_days(stations: DataFrame, active: DataFrame) -> DataFrame:
    """Every station on every day that occurs in `active`.

    The observed days are one array, at most a calendar long however far apart they lie,
    which every station unfolds; that gives all pairs without a cartesian product.
    """
    days = active.agg(F.sort_array(F.collect_set("start_date")).alias("days")).scalar()
    return spread(stations.select("station_id").distinct()).select("station_id", F.explode(days).alias("start_date"))


def station_hour_grid(stations: DataFrame, active: DataFrame) -> DataFrame:
    hours = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    return station_days(stations, active).select("station_id", "start_date", hours)


def day_panel(stations: DataFrame, daily: DataFrame) -> DataFrame:
    """(station_id, start_date, by_hour) for every station and observed day, zeros filled.

    Days count as observed when any of the given `stations` was active. Everything that
    depends on the day alone is best joined to this frame, before `unfold` makes it 24
    times as long.
    """
    own = daily.join(stations.select("station_id").distinct(), "station_id", "left_semi")
    zeros = F.array_repeat(F.lit(0).cast("bigint"), len(HOURS))
    return (station_days(stations, own).join(own, ["station_id", "start_date"], "left")
            .select("station_id", "start_date", F.coalesce("by_hour", zeros).alias("by_hour")))


def unfold(days: DataFrame, arrays: dict[str, str] | None = None) -> DataFrame:
    """Hour rows of a day panel; `arrays` names further 24-element columns to unfold."""
    arrays = arrays or {}
    plain = [c for c in days.columns if c not in ("by_hour", "station_id", "start_date", *arrays)]
    hours = days.select("station_id", "start_date", F.posexplode("by_hour").alias("hour", "trip_count"), *plain, *arrays)
    return hours.select("station_id", "start_date", "hour", "trip_count", *plain,
                        *[F.get(source, F.col("hour")).alias(name) for source, name in arrays.items()])


def zero_filled_panel(stations: DataFrame, daily: DataFrame) -> DataFrame:
    """(station_id, start_date, hour, trip_count) with zero where nobody left."""
    return unfold(day_panel(stations, daily))


def panel_summary(panel: DataFrame, by: str = "year") -> DataFrame:
    """Rows, stations, trips and the share of zero rows per year."""
    per_station = panel.groupBy(by, "station_id").agg(
        F.count("*").alias("n"), F.sum("trip_count").alias("trips"),
        F.count_if(F.col("trip_count") == 0).alias("zeros"))
    return (per_station.groupBy(by)
            .agg(F.sum("n").alias("row_count"), F.count("*").alias("stations"), F.sum("trips").alias("trips"),
                 F.round(100.0 * F.sum("zeros") / F.sum("n"), 1).alias("pct_zero"))
            .orderBy(by))


def panel_checks(panel: DataFrame, trips: DataFrame, enriched: DataFrame) -> DataFrame:
    """Zero-filling keeps the trip total, the grain is unique, enrichment keeps rows.

    Hours are collected as bits per station and day, so that days and not hours are
    shuffled; a bit set twice is a duplicate.
    """
    total = trips.agg(F.count("*")).scalar()
    sizes = enriched.agg(F.count("*")).scalar()
    bit = F.expr("shiftleft(1, hour)")
    days = panel.groupBy("station_id", "start_date").agg(
        F.count("*").alias("n"), F.sum("trip_count").alias("trips"), F.bit_count(F.bit_or(bit)).alias("hours"))
    return count_checks(days, {
        "trip total changed": F.abs(F.sum("trips") - total),
        "duplicate station-hours": F.sum("n") - F.sum("hours"),
        "rows changed by enrichment": F.abs(F.sum("n") - sizes),
    })
