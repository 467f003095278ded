"""Profiles of the fact table that set the cleaning thresholds."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewheel.contract import MAX_DURATION, MIN_DURATION


def duration_in_range(column: str = "fact_trip_duration") -> Column:
    return F.col(column).between(MIN_DURATION, MAX_DURATION)


def coverage(fact: DataFrame, day: str = "fact_trip_start_date_id", hour: str = "fact_trip_start_hour") -> DataFrame:
    """Bounds, distinct days and hours, calendar span and days without a trip.

    Distinct (day, hour) pairs come first: at most 24 rows per calendar day are left
    for the distinct counts.
    """
    pairs = fact.select(F.col(day).alias("d"), F.col(hour).alias("h")).distinct()
    span = F.datediff(F.col("max_date"), F.col("min_date")) + 1
    return (pairs.agg(F.min("d").alias("min_date"), F.max("d").alias("max_date"),
                      F.count_distinct("d").alias("distinct_days"), F.count_distinct("h").alias("distinct_hours"))
            .withColumn("span_days", span.cast("bigint"))
            .withColumn("missing_days", F.col("span_days") - F.col("distinct_days")))


def gap_runs(fact: DataFrame, day: str = "fact_trip_start_date_id") -> DataFrame:
    """Runs of calendar days without a trip: (gap_start, gap_end, days).

    The window runs over distinct days only, so over one row per calendar day at most.
    """
    days = fact.select(F.col(day).alias("d")).where("d is not null").distinct()
    following = days.withColumn("next_day", F.lead("d").over(Window.orderBy("d")))
    return following.where(F.datediff("next_day", "d") > 1).select(
        F.date_add("d", 1).alias("gap_start"), F.date_sub("next_day", 1).alias("gap_end"),
        (F.datediff("next_day", "d") - 1).alias("days"))


def duration_quantiles(fact: DataFrame, quantiles: dict[str, float], column: str = "fact_trip_duration",
                       approximate: bool = False) -> DataFrame:
    """Minimum, interpolated quantiles, maximum and the two tail counts.

    Durations are whole seconds: they are reduced to (seconds, rows) in a distributed
    aggregate first, so the exact percentile sees one weighted row per distinct value.
    `approximate` bounds the state as well, for columns with unlimited distinct values.
    """
    value = F.col(column)
    if approximate:
        source, weight, levels = fact, F.lit(1), {n: F.percentile_approx(value, q) for n, q in quantiles.items()}
    else:
        source, weight = fact.groupBy(column).agg(F.count("*").alias("n")), F.col("n")
        levels = {n: F.percentile(value, q, weight) for n, q in quantiles.items()}
    measures = {"p_min": F.min(value), **levels, "p_max": F.max(value),
                "below_minimum": F.sum(F.when(value < MIN_DURATION, weight).otherwise(0)),
                "above_maximum": F.sum(F.when(value > MAX_DURATION, weight).otherwise(0))}
    row = source.agg(*[m.cast("double").alias(n) for n, m in measures.items()])
    return row.unpivot([], row.columns, "measure", "value")


def funnel(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """Rows left after each cumulative condition and their share, in a single scan."""
    passed, counts = [], [F.count("*").alias("raw")]
    for name, condition in steps.items():
        passed.append(condition)
        counts.append(F.count_if(reduce(and_, passed)).alias(name))
    row = df.agg(*counts)
    tall = row.withColumn("total", F.col("raw")).unpivot(["total"], row.columns, "step", "row_count")
    return tall.select("step", "row_count", F.try_divide(100.0 * F.col("row_count"), F.col("total")).alias("pct"))
