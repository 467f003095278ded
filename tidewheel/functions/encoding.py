"""Model-facing expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from tidewheel.contract import CYCLES, DEMAND_BANDS


def cyclical_columns(cycles: dict[str, int] = CYCLES) -> dict[str, Column]:
    """Sine and cosine of a value that wraps after `period` steps."""
    out = {}
    for name, period in cycles.items():
        angle = F.lit(2 * math.pi) * F.col(name) / F.lit(period)
        out[f"{name}_sin"], out[f"{name}_cos"] = F.sin(angle), F.cos(angle)
    return out


def rounded(value: Column, digits: int = 6) -> Column:
    """Rounded double without a negative zero."""
    return F.round(value, digits) + F.lit(0.0)


def clipped(prediction: Column) -> Column:
    """Demand is never negative."""
    return F.greatest(prediction, F.lit(0.0))


def demand_band(actual: Column) -> Column:
    label = None
    for name, upper in DEMAND_BANDS[:-1]:
        label = F.when(actual <= upper, name) if label is None else label.when(actual <= upper, name)
    return label.otherwise(DEMAND_BANDS[-1][0])
