"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewheel.contract import SERVICE_HOLIDAYS


def season(month: Column) -> Column:
    """Meteorological season: December to February is winter, and so on."""
    names = ["winter", "spring", "summer", "fall"]
    return F.element_at(F.array(*map(F.lit, names)), (F.floor(month % 12 / 3) + 1).cast("int"))


def weekend(weekday: Column) -> Column:
    return weekday.isin(1, 7)


def calendar_columns(day: Column) -> dict[str, Column]:
    """Weekdays run from Sunday = 1 to Saturday = 7; weeks are ISO weeks."""
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "week": F.weekofyear(day),
        "weekday": F.dayofweek(day),
        "is_weekend": weekend(F.dayofweek(day)),
        "season": season(F.month(day)),
    }


def _nth_monday(year: Column, month: int, nth: int) -> Column:
    day_before = F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1)
    return F.date_add(F.next_day(day_before, "Mon"), 7 * (nth - 1))


def good_friday(year: Column) -> Column:
    """Two days before Gregorian Easter Sunday (the anonymous computus)."""
    century = F.floor(year / 100)
    golden = year % 19
    leap_shift = F.floor((century - F.floor((century + 8) / 25) + 1) / 3)
    epact = (19 * golden + century - F.floor(century / 4) - leap_shift + 15) % 30
    in_century = year % 100
    to_sunday = (32 + 2 * (century % 4) + 2 * F.floor(in_century / 4) - epact - in_century % 4) % 7
    late = F.floor((golden + 11 * epact + 22 * to_sunday) / 451)
    from_march = epact + to_sunday - 7 * late + 114
    easter = F.make_date(year, F.floor(from_march / 31).cast("int"), (from_march % 31 + 1).cast("int"))
    return F.date_sub(easter, 2)


def statutory_days(year: Column) -> Column:
    """Array of the Ontario statutory holidays of one year, with the days on which they are observed.

    New Year's Day on a weekend is observed on the Monday after it; Christmas on a Saturday, and Boxing Day with it,
    on the Monday and the Tuesday.
    """
    def on(month: int, day: int) -> Column:
        return F.make_date(year, F.lit(month), F.lit(day))

    new_year, christmas = F.dayofweek(on(1, 1)), F.dayofweek(on(12, 25))
    return F.array_compact(F.array(
        on(1, 1),
        F.when(new_year == 1, on(1, 2)).when(new_year == 7, on(1, 3)),
        F.when(year >= 2008, _nth_monday(year, 2, 3)),   # Family Day
        good_friday(year),
        F.date_sub(F.next_day(on(5, 24), "Mon"), 7),     # Monday before 25 May
        on(7, 1),
        _nth_monday(year, 9, 1),
        _nth_monday(year, 10, 2),
        on(12, 25),
        on(12, 26),
        F.when(christmas == 7, on(12, 27)),
        F.when(christmas == 7, on(12, 28)),
    ))


def statutory_holidays(years: DataFrame) -> DataFrame:
    """One `holiday` date per row for a frame with an integer `year` column."""
    return years.select(F.explode(statutory_days(F.col("year"))).alias("holiday")).distinct()


def service_holidays(spark: SparkSession) -> DataFrame:
    """The fixed list the forecasting service was built with."""
    return spark.createDataFrame([(d,) for d in SERVICE_HOLIDAYS], "text string").select(
        F.to_date("text").alias("holiday"))
