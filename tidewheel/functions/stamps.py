"""Minute-resolution wall-clock timestamps kept as text in the stage."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidewheel.contract import STAMP_FORMAT, STAMP_PATTERN


def parse_stamp(name: str | Column) -> Column:
    """Wall-clock time, or null for text that is no valid time (also in ANSI mode)."""
    return F.try_to_timestamp(name, F.lit(STAMP_FORMAT)).cast("timestamp_ntz")


def is_stamp(name: str) -> Column:
    return F.coalesce(F.col(name).rlike(STAMP_PATTERN) & parse_stamp(name).isNotNull(), F.lit(False))


def add_seconds(stamp: Column, seconds: Column) -> Column:
    """`seconds` is cut to whole seconds, as an epoch-second addition does."""
    return F.timestamp_add("SECOND", seconds.cast("bigint"), stamp)


def repaired_end() -> Column:
    """The end time as given, or start plus duration where it is not usable."""
    duration = F.col("trip_duration").try_cast("double")
    derived = F.date_format(add_seconds(parse_stamp("start_time"), duration), STAMP_FORMAT)
    return F.when(is_stamp("end_time"), F.col("end_time")).otherwise(derived)
