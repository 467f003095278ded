"""String clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidewheel.contract import INTEGER_PATTERN, UNKNOWN, USER_TYPE_LABELS


def _blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def clean_name(name: str) -> Column:
    """Trimmed name; null, blank and the literal text NULL become UNKNOWN."""
    text = F.trim(name)
    return F.when(_blank(text) | (text == "NULL"), UNKNOWN).otherwise(text)


def clean_model(name: str = "model") -> Column:
    text = F.trim(name)
    return F.when(_blank(text), UNKNOWN).otherwise(text)


def clean_user_type(name: str = "user_type") -> Column:
    """Known membership labels get their short name, unknown labels pass through."""
    text = F.trim(F.regexp_replace(name, "\r", ""))
    short = F.when(_blank(text), UNKNOWN)
    for label, value in USER_TYPE_LABELS.items():
        short = short.when(text == label, value)
    return short.otherwise(text)


def clean_bike(name: str = "bike_id") -> Column:
    return F.when(F.col(name).rlike(INTEGER_PATTERN), F.col(name)).otherwise("-1")


def single_spaced(name: str | Column) -> Column:
    """Runs of white space become one space; none at either end."""
    return F.trim(F.regexp_replace(name, r"\s+", " "))


def composite_key(*names: str) -> Column:
    return F.concat_ws("|", *[F.col(n).cast("string") for n in names])
