"""Chronological splits and their contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.contract import (BANNED_FEATURES, BUSY_THRESHOLD, CALENDAR_FEATURES, CATEGORICAL_FEATURES, PEAK_HOURS,
                                PRIOR_FEATURES, TARGET)
from tidewheel.operators.quality import count_checks


def split_label(periods: dict[str, list[int]], period: str = "year") -> Column:
    label = None
    for name, values in periods.items():
        hit = F.col(period).isin(values)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label


def check_features(features: list[str], columns: list[str]) -> list[str]:
    """Refuse features that identify the split, and features the frame lacks."""
    leaked = sorted(set(features) & set(BANNED_FEATURES))
    if leaked:
        raise ValueError(f"split columns among the features: {leaked}")
    absent = sorted(set(features + [TARGET]) - set(columns))
    if absent:
        raise ValueError(f"columns missing from the split: {absent}")
    return features


def split_by_period(df: DataFrame, periods: dict[str, list[int]], period: str = "year",
                    features: list[str] | None = None) -> DataFrame:
    """Feature columns, target, start_date and `split`; other periods drop out.

    The filter is on the period column itself, so a partitioned table is pruned.
    """
    names = check_features(features or CALENDAR_FEATURES + PRIOR_FEATURES, df.columns)
    _check_order(periods)
    wanted = [p for values in periods.values() for p in values]
    return df.where(F.col(period).isin(wanted)).select(
        *names, TARGET, "start_date", split_label(periods, period).alias("split"))


def _check_order(periods: dict[str, list[int]]) -> None:
    names = list(periods)
    for earlier, later in zip(names, names[1:]):
        if max(periods[earlier]) >= min(periods[later]):
            raise ValueError(f"{earlier} and {later} overlap")


def split_summary(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(
        F.count("*").alias("row_count"), F.sum(TARGET).alias("trips"),
        F.min("start_date").alias("from_date"), F.max("start_date").alias("to_date"))


def split_checks(split: DataFrame, source: DataFrame, order: list[str]) -> DataFrame:
    """No date overlap between consecutive splits and an unchanged target sum."""
    bounds = split.groupBy().pivot("split", order).agg(
        F.min("start_date").alias("lo"), F.max("start_date").alias("hi"), F.sum(TARGET).alias("trips"))
    total = source.agg(F.sum(TARGET)).scalar()
    kept = sum((F.max(f"{name}_trips") for name in order[1:]), F.max(f"{order[0]}_trips"))
    overlaps = {f"{a}/{b} overlap": (F.max(f"{a}_hi") >= F.min(f"{b}_lo")).cast("int")
                for a, b in zip(order, order[1:])}
    return count_checks(bounds, {**overlaps, "target sum changed": F.abs(kept - total)})


def split_contract(split: DataFrame, periods: dict[str, list[int]], segment: str, baseline_mae: DataFrame,
                   model: str) -> DataFrame:
    """One row that downstream reads instead of repeating constants.

    `baseline_mae` is a one-row, one-column frame. The station list has one entry per
    pool station, so it is bounded by the pool.
    """
    features = [c for c in split.columns if c not in (TARGET, "start_date", "split")]

    def texts(values: list[str]) -> Column:
        return F.array(*map(F.lit, values))

    def ints(values: list[int]) -> Column:
        return F.array(*map(F.lit, values))

    stations = split.select("station_id").distinct().agg(
        F.array_sort(F.collect_list("station_id")).alias("station_pool"))
    return stations.select(
        F.lit(segment).alias("segment"), F.lit(TARGET).alias("target"), texts(features).alias("features"),
        texts(CATEGORICAL_FEATURES).alias("categorical"), texts(PRIOR_FEATURES).alias("prior_year"),
        ints(PEAK_HOURS).alias("peak_hours"), F.lit(BUSY_THRESHOLD).alias("busy_threshold"),
        *[ints(years).alias(f"{name}_years") for name, years in periods.items()],
        "station_pool", F.lit(model).alias("selected_model"),
        baseline_mae.scalar().alias("baseline_val_mae"))
