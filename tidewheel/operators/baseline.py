"""Cell models: one statistic per (station, hour, weekday), global fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.contract import CELL_KEYS, TARGET
from tidewheel.session import materialize


def quantile_of(q: float, target: str = TARGET) -> Column:
    """Exact quantile; a cell holds few distinct counts, so its state stays small."""
    return F.percentile(target, q)


def fit_cells(train: DataFrame, models: dict[str, Column], keys: list[str] = CELL_KEYS) -> DataFrame:
    """One row per cell with one column per model and the cell's sums.

    A fitted model is a table: it is written once, and its file size tells Catalyst
    whether a later join may broadcast it.
    """
    return materialize(train.groupBy(*keys).agg(
        *[m.alias(n) for n, m in models.items()],
        F.sum(TARGET).alias("cell_sum"), F.count(TARGET).alias("cell_rows")), "cells")


def global_mean(cells: DataFrame) -> Column:
    """Mean over all training rows, taken from the cells instead of a second scan."""
    return cells.agg(F.try_divide(F.sum("cell_sum"), F.sum("cell_rows"))).scalar()


def predict_cells(df: DataFrame, cells: DataFrame, models: list[str], keys: list[str] = CELL_KEYS) -> DataFrame:
    """Add one prediction per model; `fallback` marks rows of cells never trained."""
    found = cells.select(*keys, *models, F.lit(True).alias("_found"))
    joined = df.join(found, keys, "left")
    mean = global_mean(cells)
    return joined.select(*df.columns, *[F.coalesce(m, mean).alias(m) for m in models],
                         F.col("_found").isNull().alias("fallback"))


def unseen_cells(df: DataFrame, cells: DataFrame, keys: list[str] = CELL_KEYS) -> DataFrame:
    """Cells and rows of `df` that training never saw, counted per cell first."""
    used = df.groupBy(*keys).agg(F.count("*").alias("n"))
    lost = used.join(cells.select(*keys), keys, "left_anti")
    return lost.agg(F.count("*").alias("unseen_cells"), F.coalesce(F.sum("n"), F.lit(0)).alias("unseen_rows"))


def tall_predictions(df: DataFrame, models: list[str], keep: list[str]) -> DataFrame:
    """(keep.., y, model, pred) with one row per model."""
    return df.select(*keep, F.col(TARGET).cast("double").alias("y"),
                     F.explode(F.create_map(*[x for m in models for x in (F.lit(m), F.col(m).cast("double"))]))
                     .alias("model", "pred"))
