"""Stage clean-up: drop rows whose keys are unusable, repair everything else."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.contract import INTEGER_PATTERN, NUMBER_PATTERN
from tidewheel.functions import stamps, text


#: The largest values of the key columns' types, as text.
_LARGEST = {"trip_id": str(2 ** 63 - 1), "start_station_id": str(2 ** 31 - 1), "end_station_id": str(2 ** 31 - 1)}


def _fits(name: str) -> Column:
    """Digits whose number the key's type can hold, judged as text: a cast of every row costs more than the rest."""
    digits, largest = F.ltrim(F.col(name), F.lit("0")), _LARGEST[name]
    return F.col(name).rlike(INTEGER_PATTERN) & (
        (F.length(name) < len(largest)) | (F.length(digits) < len(largest))
        | ((F.length(digits) == len(largest)) & (digits <= largest)))


def key_rules() -> dict[str, Column]:
    """One condition per key column; a null condition counts as broken, as does a number beyond the key's type.

    The cast of the duration is the `try_` kind: conditions joined by `&` are not evaluated in
    a guaranteed order, so a pattern test does not protect a failing cast in ANSI mode.
    """
    duration = F.col("trip_duration")
    return {
        **{c: _fits(c) for c in _LARGEST},
        "trip_duration": duration.rlike(NUMBER_PATTERN) & (duration.try_cast("double") > 0),
        "start_time": stamps.is_stamp("start_time"),
    }


def is_valid() -> Column:
    return reduce(and_, [F.coalesce(rule, F.lit(False)) for rule in key_rules().values()])


def valid_rows(stage: DataFrame) -> DataFrame:
    return stage.where(is_valid())


def repairs() -> dict[str, Column]:
    return {
        "end_time": stamps.repaired_end(),
        "start_station_name": text.clean_name("start_station_name"),
        "end_station_name": text.clean_name("end_station_name"),
        "user_type": text.clean_user_type(),
        "bike_id": text.clean_bike(),
        "model": text.clean_model(),
    }


def repair(stage: DataFrame) -> DataFrame:
    fixes = repairs()
    return stage.select(*[fixes[c].alias(c) if c in fixes else F.col(c) for c in stage.columns])


def clean(stage: DataFrame) -> DataFrame:
    return repair(valid_rows(stage))


def clean_audit(stage: DataFrame) -> DataFrame:
    """Rows before, dropped and after, from a single pass."""
    return (stage.agg(F.count("*").alias("before_rows"), F.count_if(is_valid()).alias("after_rows"))
            .select("before_rows", (F.col("before_rows") - F.col("after_rows")).alias("dropped_rows"),
                    "after_rows"))
