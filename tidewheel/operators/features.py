"""Calendar, cyclical and prior-year features of the panel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewheel.contract import CYCLES, PRIOR_FEATURES, TARGET
from tidewheel.functions.encoding import cyclical_columns
from tidewheel.operators import panel
from tidewheel.operators.quality import count_checks, verdict

# panel column <- dim_date column
_CALENDAR = {"year": "year", "quarter": "quarter", "month": "month", "weekday": "weekday",
             "week_of_year": "week", "is_weekend": "is_weekend", "is_holiday": "is_holiday", "season": "season"}


def add_calendar(frame: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Attributes of the start date; flags become 0/1."""
    days = dim_date.select(F.col("dim_date_id").alias("start_date"), *[
        (F.col(f"dim_date_{src}").cast("tinyint") if src.startswith("is_") else F.col(f"dim_date_{src}")).alias(name)
        for name, src in _CALENDAR.items()])
    return frame.join(days, "start_date").select(*frame.columns, *_CALENDAR)


def add_cyclical(df: DataFrame, cycles: dict[str, int] = CYCLES) -> DataFrame:
    return df.withColumns(cyclical_columns(cycles))


def add_prior_year(days: DataFrame, period: str = "year") -> DataFrame:
    """Unfold a day panel with calendar columns and add the two means of the period before.

    The means are over the zero-filled rows: per station, hour and weekday, and per
    station and month. They are filed under the following period, so a row only sees
    the one before it; keys without history give null. Both are computed and joined per
    day, on a 24th of the rows. `period` is the calendar year; shorter series can use
    any integer period column.
    """
    by_hour = F.col("by_hour")
    following = (F.col(period) + 1).cast("int").alias(period)
    per_hour = days.groupBy("station_id", following, "weekday").agg(
        F.array(*[F.avg(by_hour[h]) for h in panel.HOURS]).alias("hour_means"))
    day_total = F.aggregate(by_hour, F.lit(0).cast("bigint"), lambda total, n: total + n)
    per_month = days.groupBy("station_id", following, "month").agg(
        (F.sum(day_total) / (F.count("*") * len(panel.HOURS))).alias(PRIOR_FEATURES[1]))
    joined = (days.join(per_hour, ["station_id", period, "weekday"], "left")
              .join(per_month, ["station_id", period, "month"], "left"))
    hours = panel.unfold(joined, {"hour_means": PRIOR_FEATURES[0]})
    return hours.select(*[c for c in hours.columns if c not in PRIOR_FEATURES], *PRIOR_FEATURES)


def featured(days: DataFrame, dim_date: DataFrame) -> DataFrame:
    """All features of a day panel, one row per station and hour."""
    return add_cyclical(add_prior_year(add_calendar(days, dim_date)))


def feature_population(df: DataFrame, by: str = "year", features: list[str] = PRIOR_FEATURES) -> DataFrame:
    """Share of rows with a value, per period."""
    return df.groupBy(by).agg(*[F.avg(F.col(f).isNotNull().cast("int")).alias(f) for f in features]).orderBy(by)


def wrap_check(df: DataFrame, column: str = "hour", period: int = 24) -> DataFrame:
    """Distance of the encodings across the wrap and of one ordinary step."""
    sin, cos = F.col(f"{column}_sin"), F.col(f"{column}_cos")

    def at(value: int, part: Column) -> Column:
        return F.max(F.when(F.col(column) == value, part))

    def distance(a: int, b: int) -> Column:
        return F.hypot(at(a, sin) - at(b, sin), at(a, cos) - at(b, cos))

    row = df.agg(distance(period - 1, 0).alias("wrap_distance"), distance(1, 0).alias("step_distance"))
    same = F.abs(F.col("wrap_distance") - F.col("step_distance")) < 1e-8
    return row.withColumn("status", F.when(same, "ok").otherwise("FAIL"))


def parity(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str], tolerance: float = 1e-4) -> DataFrame:
    """Mismatches per column between two builds of the same rows, plus missing rows."""
    kinds = dict(a.dtypes)

    def differs(name: str) -> Column:
        left, right = F.col(f"a.{name}"), F.col(f"b.{name}")
        if kinds[name] in ("string", "date"):
            return ~left.eqNullSafe(right)
        far = F.abs(left.cast("double") - right.cast("double")) > tolerance
        return F.coalesce(far, left.isNull() != right.isNull())

    same_key = reduce(lambda x, y: x & y, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys])
    joined = (a.select(*keys, *columns).alias("a")
              .join(b.select(*keys, *columns).alias("b"), same_key, "full_outer"))
    paired = F.col(f"a.{keys[0]}").isNotNull() & F.col(f"b.{keys[0]}").isNotNull()
    return count_checks(joined, {"unpaired rows": F.count_if(~paired),
                                 **{c: F.count_if(paired & differs(c)) for c in columns}})


def prior_year_checks(stored: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Recompute both prior-year means by a window over years and compare.

    An independent formula: per cell, the mean of the rows exactly one year back.
    """
    reports = []
    for name, keys in zip(PRIOR_FEATURES, (["hour", "weekday"], ["month"])):
        cells = stored.groupBy("station_id", *keys, "year").agg(
            F.avg(TARGET).alias("mean"), F.min(name).alias("low"), F.max(name).alias("high"),
            F.count_if(F.col(name).isNull()).alias("empty"), F.count("*").alias("n"))
        back = Window.partitionBy("station_id", *keys).orderBy("year").rangeBetween(-1, -1)
        checked = cells.withColumn("expected", F.max("mean").over(back))
        wrong = F.when(F.col("expected").isNull(), F.col("empty") < F.col("n")).otherwise(
            (F.col("empty") > 0) | (F.abs(F.col("low") - F.col("expected")) > tolerance)
            | (F.abs(F.col("high") - F.col("expected")) > tolerance))
        reports.append(checked.agg(F.lit(name).alias("feature"), F.count("*").alias("cells"),
                                   F.count_if(wrong).alias("violations")))
    return reports[0].unionByName(reports[1]).withColumn("status", verdict(F.col("violations")))
