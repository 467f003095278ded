"""Trip tables derived from the order and event tables.

`ordered_trips` come from order lines: several years, duplicate source ids, and, as
`raw_stage`, text columns with every kind of dirt the clean-up has to handle.
`event_trips` come from the event log: one month with real clock times. Every row of the
source tables becomes a trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewheel.contract import STAMP_FORMAT, STAGE_COLUMNS
from tidewheel.functions.calendar import statutory_holidays
from tidewheel.operators import cleaning, dimensions, features, panel, pool, splits
from tidewheel.session import bound_methods, materialize

POOL_FIRST_BY, POOL_LAST_FROM = "1995-01-31", "2001-06-01"
YEAR_SPLIT = {"train": [1995, 1996, 1997, 1998], "val": [1999], "test": [2000, 2001]}
WEEK_SPLIT = {"train": [1, 2], "val": [3], "test": [4, 5]}
BUSY = 5
ZONE_USERS = 20


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A test table, in a session in which what is derived from it is compiled."""
    bound_methods(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _case(value: Column, cases: dict[int, str | None], otherwise: Column) -> Column:
    out = None
    for key, text in cases.items():
        hit, shown = value == key, F.lit(text).cast("string")
        out = F.when(hit, shown) if out is None else out.when(hit, shown)
    return out.otherwise(otherwise)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("s"), F.col("l_quantity").alias("q"))
    orders = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("d"), F.col("o_orderpriority").alias("pr"))
    p = F.col("p")
    seconds = F.when(p % 401 == 0, 30).when(p % 409 == 1, 90000).otherwise(F.col("q") * 60 + p % 53)
    minute_of_day = (F.col("k") * 7 + F.col("n")) % 24 * 60 + p % 60
    return (lines.join(orders, "k").withColumns({
        "secs": seconds.cast("int"), "e": (p * 31 + F.col("n")) % 997, "st": F.timestamp_add("MINUTE", minute_of_day, "d")})
        .withColumn("et", F.timestamp_add("SECOND", "secs", "st")))


def _fact_shape(df: DataFrame, trip_id: Column, start: str, end: str, station: Column, end_station: Column,
                bike: Column, seconds: Column, user_type: Column) -> DataFrame:
    parts = {}
    for side, stamp in (("start", start), ("end", end)):
        parts[f"fact_trip_{side}_ts"] = F.col(stamp)
        parts[f"fact_trip_{side}_date_id"] = F.to_date(stamp)
        parts[f"fact_trip_{side}_hour"] = F.hour(stamp)
        parts[f"fact_trip_{side}_minute"] = F.minute(stamp)
    named = {
        "fact_trip_id": trip_id, "fact_trip_source_id": trip_id, "fact_trip_duration": seconds, **parts,
        "fact_trip_start_station_id": station.cast("int"), "fact_trip_end_station_id": end_station.cast("int"),
        "fact_trip_bike_id": bike.cast("int"), "fact_trip_user_type_id": user_type.cast("int"),
        "start_year": F.year(start), "start_month": F.month(start)}
    return df.select(*[c.alias(n) for n, c in named.items()])


def ordered_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Fact-shaped trips over several years, one per order line."""
    return _fact_shape(_lines(spark, folder), F.col("k") * 8 + F.col("n"), "st", "et", F.col("s"), F.col("e"),
                       F.col("p"), F.col("secs"), F.substring("pr", 1, 1))


def raw_stage(spark: SparkSession, folder: str) -> DataFrame:
    """All-text stage rows with dirt."""
    df, k, n, p, s, e = _lines(spark, folder), *map(F.col, "knpse")
    text = {c: F.col(c).cast("string") for c in ("p", "s", "e", "secs")}
    rev = (F.year("d") - 1994).cast("string")

    def shown(stamp: str) -> Column:
        return F.date_format(stamp, STAMP_FORMAT)

    def iso(stamp: str) -> Column:
        return F.date_format(stamp, "yyyy-MM-dd HH:mm")

    placeholder = F.lit("NULL")
    casual = "Casual Member\r"
    member = (F.when(F.col("pr") == "1-URGENT", "Annual Member").when(F.col("pr") == "2-HIGH", casual)
              .when(F.col("pr") == "3-MEDIUM", " Annual Member ")
              .when(F.col("pr") == "5-LOW", "Corporate").when(k % 2 == 0, F.lit(None).cast("string")).otherwise(" "))
    columns = {
        "trip_id": _case(k % 97, {1: None, 2: "abc"}, (k * 8 + n).cast("string")),
        "trip_duration": _case(p % 89, {3: "0", 4: "abc", 5: "-5", 6: None},
                               F.when(p % 89 == 7, F.concat(text["secs"], F.lit(".9"))).otherwise(text["secs"])),
        "start_time": F.when((k + n) % 83 == 2, iso("st")).otherwise(
            _case((k + n) % 83, {1: "13/45/2019 10:00", 3: None}, shown("st"))),
        "start_station_id": _case(k % 79, {1: None, 2: "X1"}, text["s"]),
        "start_station_name": F.when(s % 37 == 5, placeholder).otherwise(
            _case(k % 13, {0: "NULL", 1: " ", 2: None},
                  F.concat(F.lit(" Dock "), text["s"], F.lit(" rev "), rev, F.lit(" ")))),
        "end_time": F.when((k + n) % 11 == 1, iso("et")).otherwise(_case((k + n) % 11, {0: None}, shown("et"))),
        "end_station_id": _case(k % 73, {1: None}, text["e"]),
        "end_station_name": F.when(e % 37 == 5, placeholder).otherwise(
            _case(k % 17, {0: None}, F.concat(F.lit("Dock "), text["e"], F.lit(" rev "), rev,
                                              F.when(n % 2 == 0, "b").otherwise("")))),
        "bike_id": _case(p % 19, {0: "", 1: "X1", 2: None}, text["p"]),
        "user_type": member,
        "model": _case(k % 3, {0: None, 1: " "}, F.concat(F.lit(" Model-"), (p % 26).cast("string"), F.lit(" "))),
    }
    return df.select(*[columns[c].alias(c) for c in STAGE_COLUMNS], F.year("d").cast("string").alias("source_year"))


def clean_stage(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean(raw_stage(spark, folder))


def event_trips(spark: SparkSession, folder: str, zones: bool = False) -> DataFrame:
    """Fact-shaped trips of one month, one per event.

    Stations are the users, or with `zones` twenty of them each, so that some hours are busy. Both grow with the table.
    """
    user = F.col("user_id")
    station = F.floor(user / ZONE_USERS) if zones else user
    k = F.regexp_extract("props", r"([0-9]+)", 1).cast("int")
    kinds = F.array_position(F.array(*map(F.lit, ["click", "error", "purchase", "signup", "view"])), F.col("event_type"))
    events = read(spark, folder, "events").withColumn("secs", F.round(F.col("value") * 60).cast("int"))
    events = events.withColumn("et", F.timestamp_add("SECOND", "secs", "ts"))
    return _fact_shape(events, F.col("event_id"), "ts", "et", station, k, user, F.col("secs"), kinds)


def suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("int").alias("dim_station_id"), F.col("s_name").alias("dim_station_name"))


def priorities(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_user_type(read(spark, folder, "orders").select(F.col("o_orderpriority").alias("user_type")))


def event_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_user_type(read(spark, folder, "events").select(F.col("event_type").alias("user_type")))


def calendar(fact: DataFrame) -> DataFrame:
    """dim_date spanning a fact table's start and end dates."""
    bounds = fact.agg(F.min("fact_trip_start_date_id").alias("first_date"),
                      F.max("fact_trip_end_date_id").alias("last_date"))
    return with_holidays(bounds)


def with_holidays(bounds: DataFrame) -> DataFrame:
    years = bounds.select(F.explode(F.sequence(F.year("first_date"), F.year("last_date"))).alias("year"))
    return dimensions.dim_date(bounds, statutory_holidays(years))


def year_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Daily counters of all stations, written once: the one pass over the trips."""
    return materialize(panel.daily_counts(pool.departures(ordered_trips(spark, folder))), "daily")


def year_pool(spark: SparkSession, folder: str, daily: DataFrame | None = None) -> DataFrame:
    daily = year_daily(spark, folder) if daily is None else daily
    chosen = pool.station_pool(pool.yearly_activity(daily), suppliers(spark, folder), POOL_FIRST_BY, POOL_LAST_FROM)
    return materialize(chosen, "pool")


def year_days(spark: SparkSession, folder: str, daily: DataFrame | None = None) -> DataFrame:
    """Day panel of the pool with calendar columns."""
    daily = year_daily(spark, folder) if daily is None else daily
    return with_calendar(panel.day_panel(year_pool(spark, folder, daily), daily), daily)


def with_calendar(frame: DataFrame, daily: DataFrame) -> DataFrame:
    """Calendar columns from a dimension that spans the days of `daily`."""
    bounds = daily.agg(F.min("start_date").alias("first_date"), F.max("start_date").alias("last_date"))
    return features.add_calendar(frame, with_holidays(bounds))


def year_calendar(spark: SparkSession, folder: str, daily: DataFrame | None = None) -> DataFrame:
    return panel.unfold(year_days(spark, folder, daily))


def year_features(spark: SparkSession, folder: str, daily: DataFrame | None = None) -> DataFrame:
    return features.add_cyclical(features.add_prior_year(year_days(spark, folder, daily)))


def year_split(spark: SparkSession, folder: str, names: list[str] | None = None,
               daily: DataFrame | None = None) -> DataFrame:
    """The yearly split, frozen on disk; all features, or only the calendar ones named.

    Splits of one query share `daily`, the one table that takes a pass over the trips.
    """
    source = (year_features if names is None else year_calendar)(spark, folder, daily)
    return materialize(splits.split_by_period(source, YEAR_SPLIT, features=names), "split")


def event_daily(spark: SparkSession, folder: str, zones: bool = False) -> DataFrame:
    return materialize(panel.daily_counts(pool.departures(event_trips(spark, folder, zones))), "daily")


def event_days(spark: SparkSession, folder: str, zones: bool = False) -> DataFrame:
    """Day panel of all stations of the month, with calendar columns."""
    daily = event_daily(spark, folder, zones)
    return with_calendar(panel.day_panel(daily, daily), daily)


def event_counts(spark: SparkSession, folder: str) -> DataFrame:
    daily = event_daily(spark, folder)
    return panel.zero_filled_panel(daily, daily)


def event_panel(spark: SparkSession, folder: str, zones: bool = False) -> DataFrame:
    return panel.unfold(event_days(spark, folder, zones))


def week_split(spark: SparkSession, folder: str, zones: bool = True) -> DataFrame:
    """Event panel split by ISO week; prior features look one week back.

    Frozen on disk, as later steps read it more than once.
    """
    frame = features.add_cyclical(features.add_prior_year(event_days(spark, folder, zones), "week_of_year"))
    return materialize(splits.split_by_period(frame, WEEK_SPLIT, "week_of_year"), "split")
