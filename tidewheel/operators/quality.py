"""Expectations and profiles. Every suite is one aggregation, not one job per check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.contract import INTEGER_PATTERN, STAMP_PATTERN
from tidewheel.functions.stamps import parse_stamp


def verdict(violations: Column) -> Column:
    return F.when(violations == 0, "ok").otherwise("FAIL")


def _tall(one_row: DataFrame, name: str, value: str) -> DataFrame:
    return one_row.unpivot([], one_row.columns, name, value)


def count_checks(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """(check, violations, status) for aggregates that count violations."""
    row = df.agg(*[c.cast("bigint").alias(name) for name, c in counts.items()])
    return _tall(row, "check", "violations").withColumn("status", verdict(F.col("violations")))


def expectations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Count the rows for which a condition is true, all conditions in one pass."""
    return count_checks(df, {name: F.count_if(cond) for name, cond in checks.items()})


def null_counts(df: DataFrame) -> dict[str, Column]:
    return {c: F.count_if(F.col(c).isNull()) for c in df.columns}


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and their share for every column."""
    total = "row count of the frame"
    row = df.agg(F.count("*").alias(total), *[n.alias(c) for c, n in null_counts(df).items()])
    tall = row.unpivot([total], df.columns, "column_name", "nulls")
    return tall.select("column_name", "nulls", F.try_divide("nulls", total).alias("share"))


def _not(cond: Column) -> Column:
    return ~cond


def stage_checks(stage: DataFrame) -> DataFrame:
    """Key formats, literal NULL names, nulls per column and unreadable start times."""
    return expectations(stage, {
        "trip_id not int": _not(F.col("trip_id").rlike(INTEGER_PATTERN)),
        "duration <= 0": F.col("trip_duration").try_cast("double") <= 0,
        "start_time malformed": _not(F.col("start_time").rlike(STAMP_PATTERN)),
        "end_time malformed": _not(F.col("end_time").rlike(STAMP_PATTERN)),
        "start_station_id not int": _not(F.col("start_station_id").rlike(INTEGER_PATTERN)),
        "end_station_id not int": _not(F.col("end_station_id").rlike(INTEGER_PATTERN)),
        "literal 'NULL' name": (F.col("start_station_name") == "NULL") | (F.col("end_station_name") == "NULL"),
        "start_time unparseable": parse_stamp("start_time").isNull(),
        **{f"{c} null": F.col(c).isNull() for c in stage.columns},
    })


def dim_date_checks(dim: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Gaps, duplicates, value ranges, weekday and weekend alignment."""
    day = F.col("dim_date_id")
    ranges = {
        "quarter": (1, 4), "month": (1, 12), "day": (1, 31), "week": (1, 53), "weekday": (1, 7),
        "year": (first_year, last_year),
    }
    span = F.datediff(F.max(day), F.min(day)) + 1
    counts = {
        "gaps": span - F.count_distinct(day),
        "duplicates": F.count("*") - F.count_distinct(day),
        **{f"{part} not {lo}-{hi}": F.count_if(_not(F.col(f"dim_date_{part}").between(lo, hi)))
           for part, (lo, hi) in ranges.items()},
        "season invalid": F.count_if(_not(F.col("dim_date_season").isin("winter", "spring", "summer", "fall"))),
        "weekday mismatch": F.count_if(F.dayofweek(day) != F.col("dim_date_weekday")),
        "weekend mismatch": F.count_if(F.col("dim_date_is_weekend") != F.col("dim_date_weekday").isin(1, 7)),
    }
    return count_checks(dim, counts)


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first per key value, counted on pre-aggregated groups."""
    groups = df.groupBy(key).agg(F.count("*").alias("n"))
    return groups.agg(F.sum("n").alias("row_count"), F.count("*").alias("groups"),
                      F.count(key).alias("distinct_keys")).select(
        F.lit(key).alias("key_column"), F.coalesce("row_count", F.lit(0)).alias("row_count"), "distinct_keys",
        (F.coalesce("row_count", F.lit(0)) - F.col("groups")).alias("duplicates"))


def missing_keys(used: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Rows of `used` whose key is not in the dimension, as a one-row `violations`.

    Keys are reduced to (key, rows) before the anti join, so neither a hot key nor the
    fact itself is shuffled. A null key has no partner and counts as missing.
    """
    groups = used.groupBy(F.col(key).alias(dim_key)).agg(F.count("*").alias("n"))
    lost = groups.join(dim.select(dim_key), dim_key, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))


def _used_keys(fact: DataFrame, columns: list[str]) -> DataFrame:
    """(column, key, n) for several key columns in one pass.

    The rows unfold per column only up to the partial aggregate, so what is shuffled is
    one row per column, key and task, however hot a key is.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("key")) for c in columns]
    return fact.select(F.inline(F.array(*pairs))).groupBy("column", "key").agg(F.count("*").alias("n"))


def _known_keys(links: list[tuple[str, DataFrame, str]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        dim.select(F.lit(column).alias("column"), F.col(pk).cast("string").alias("key")) for column, dim, pk in links])


def orphans(fact: DataFrame, links: list[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """One row per foreign key: (foreign_key, dimension, violations, status)."""
    used = _used_keys(fact, [fk for fk, *_ in links])
    lost = used.join(_known_keys([(fk, dim, pk) for fk, _, dim, pk in links]), ["column", "key"], "left_anti")
    counts = lost.groupBy(F.col("column").alias("foreign_key")).agg(F.sum("n").alias("lost"))
    listed = fact.sparkSession.createDataFrame([(fk, name) for fk, name, *_ in links],
                                               "foreign_key string, dimension string")
    return listed.join(counts, "foreign_key", "left").select(
        "foreign_key", "dimension", F.coalesce("lost", F.lit(0)).alias("violations")).withColumn(
        "status", verdict(F.col("violations")))


def star_links(dims: dict[str, DataFrame]) -> list[tuple[str, str, DataFrame, str]]:
    def link(column: str, dim: str) -> tuple[str, str, DataFrame, str]:
        return f"fact_trip_{column}", dim, dims[dim], f"{dim}_id"

    return [link("start_date_id", "dim_date"), link("end_date_id", "dim_date"),
            link("start_station_id", "dim_station"), link("end_station_id", "dim_station"),
            link("bike_id", "dim_bike"), link("user_type_id", "dim_user_type")]


def referential_integrity(fact: DataFrame, dim_station: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Dimension size, stations in use, and distinct keys without a dimension row."""
    station, date = "fact_trip_start_station_id", "fact_trip_start_date_id"
    used = _used_keys(fact, [station, date])
    known = _known_keys([(station, dim_station, "dim_station_id"), (date, dim_date, "dim_date_id")])
    marked = used.join(known.withColumn("known", F.lit(True)), ["column", "key"], "left")

    def kind(column: str) -> Column:
        return F.col("column") == column

    lost = F.col("known").isNull()
    row = marked.agg(F.count_if(kind(station) & F.col("key").isNotNull()).alias("active_stations"),
                     F.count_if(kind(station) & lost).alias("orphan_stations"),
                     F.count_if(kind(date) & lost).alias("orphan_dates"))
    sizes = dim_station.agg(F.lit("dim_stations").alias("measure"), F.count("*").alias("value"))
    return sizes.unionByName(_tall(row, "measure", "value"))


def dimension_checks(dim: DataFrame, key: str, used: DataFrame, used_key: str) -> DataFrame:
    """Duplicate keys, null keys, and stage keys the dimension lacks."""
    name = key.removesuffix("_id")
    own = count_checks(dim, {
        f"{name} duplicate keys": F.count("*") - F.count_distinct(F.col(key)),
        f"{name} null keys": F.count_if(F.col(key).isNull()),
    })
    lost = missing_keys(used.select(used_key).distinct(), dim, used_key, key)
    return own.unionByName(lost.select(F.lit(f"{name} missing stage keys").alias("check"), "violations",
                                       verdict(F.col("violations")).alias("status")))


def fact_checks(fact: DataFrame, stage: DataFrame) -> DataFrame:
    """Row parity with the stage, unique keys, nulls and value ranges.

    Uniqueness is counted on grouped keys; everything else is one pass over the fact.
    """
    between = {"start_hour": (0, 23), "start_minute": (0, 59), "end_hour": (0, 23), "end_minute": (0, 59)}
    rows = expectations(fact, {
        "duration <= 0": F.col("fact_trip_duration") <= 0,
        **{f"{c} not {lo}-{hi}": _not(F.col(f"fact_trip_{c}").between(lo, hi)) for c, (lo, hi) in between.items()},
        "end before start": F.col("fact_trip_end_ts") < F.col("fact_trip_start_ts"),
        "date_id != ts date": F.to_date("fact_trip_start_ts") != F.col("fact_trip_start_date_id"),
        **{f"{c} null": F.col(c).isNull() for c in fact.columns},
    })
    unique = [duplicates(fact, key).select(F.lit(f"duplicate {key}").alias("check"),
                                           F.col("duplicates").alias("violations"))
              for key in ("fact_trip_id", "fact_trip_source_id")]
    sizes = (stage.agg(F.count("*").alias("n")).unionByName(fact.agg((-F.count("*")).alias("n")))
             .agg(F.abs(F.sum("n")).alias("violations"))
             .select(F.lit("rows lost from stage").alias("check"), "violations"))
    more = reduce(DataFrame.unionByName, [*unique, sizes]).withColumn("status", verdict(F.col("violations")))
    return rows.unionByName(more)


def rows_per(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("row_count")).orderBy(*columns)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("row_count"))
    return counts.orderBy(F.desc("row_count"), "value")


def month_histogram(stage: DataFrame) -> DataFrame:
    return stage.groupBy(F.month(parse_stamp("start_time")).alias("month")).agg(
        F.count("*").alias("row_count")).orderBy("month")


def holidays_per_year(dim: DataFrame) -> DataFrame:
    return dim.groupBy("dim_date_year").agg(
        F.count_if("dim_date_is_holiday").alias("holidays"),
        F.count_if("dim_date_is_weekend").alias("weekend_days"),
        F.count("*").alias("days")).orderBy("dim_date_year")


def key_profile(fact: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Total rows, nulls of the given columns and distinct keys, as one tall report."""
    distinct = fact.groupBy(key).agg(F.count("*").alias("n"), *[
        F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])
    row = distinct.agg(F.sum("n").alias("total"), *[F.sum(f"null_{c}").alias(f"null_{c}") for c in columns],
                       F.count(key).alias("distinct_ids"))
    return _tall(row, "measure", "value")
