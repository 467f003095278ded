"""Batches of forecast requests, built as JSON text from the event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewheel.contract import CALENDAR_FEATURES, CELL_KEYS, PRIOR_FEATURES
from tidewheel.functions.calendar import statutory_holidays
from tidewheel.functions.encoding import rounded
from tidewheel.operators import baseline, requests
from tidewheel.queries.check_sql import with_ctes
from tidewheel.queries.registry import query
from tidewheel.queries.standins import event_panel, read
from tidewheel.session import materialize


def _record(station: Column, date: Column | None, hour: Column) -> Column:
    parts = [F.lit('{"station_id":'), station.cast("string")]
    if date is not None:
        parts += [F.lit(',"date":"'), date, F.lit('"')]
    return F.concat(*parts, F.lit(',"hour":'), hour.cast("string"), F.lit("}"))


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    """One request text per event: every envelope form and every kind of mistake."""
    station, hour = F.col("user_id"), F.hour("ts")
    day = F.date_format(F.date_add(F.to_date("ts"), F.when(F.col("event_id") % 2 == 0, 60).otherwise(0)), "yyyy-MM-dd")
    one, next_hour = _record(station, day, hour), _record(station, day, (hour + 1) % 24)
    pair = F.concat(F.lit("["), one, F.lit(","), next_hour, F.lit("]"))
    known = {"station_id": station, "season": F.lit('"winter"'), "hour": hour}
    numbers = [f for f in CALENDAR_FEATURES + PRIOR_FEATURES if f not in known]
    full = F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), c.cast("string")) for n, c in known.items()],
                       *[F.lit(f'"{n}":1') for n in numbers])
    some = F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), c.cast("string")) for n, c in known.items() if n != "season"],
                       *[F.lit(f'"{n}":1') for n in numbers if n != "month_cos"])
    direct = F.concat(F.lit('{"rawPath":"/predict","body":{'),
                      F.when(F.floor(F.col("event_id") / 12) % 2 == 0, some).otherwise(full), F.lit("}}"))
    forms = {
        0: pair,
        1: F.concat(F.lit('{"instances":'), pair, F.lit("}")),
        2: F.concat(F.lit('{"rawPath":"/forecast","body":"'), F.replace(one, F.lit('"'), F.lit('\\"')), F.lit('"}')),
        3: _record(F.lit(99999999), day, hour),
        4: _record(station, day, F.lit(24)),
        5: _record(station, None, hour),
        6: _record(station, F.lit("2024-02-30"), hour),
        7: F.lit("[]"),
        8: F.lit("no json {"),
        9: F.concat(F.lit("["), one, F.lit(","), _record(station, day, F.lit(-1)), F.lit("]")),
        10: F.concat(F.lit('{"station_id":"'), station.cast("string"), F.lit('","date":"'), day,
                     F.lit('","hour":"'), hour.cast("string"), F.lit('"}')),
        11: direct,
    }
    body = None
    for m, text in forms.items():
        hit = F.col("event_id") % 12 == m
        body = F.when(hit, text) if body is None else body.when(hit, text)
    return read(spark, folder, "events").select(F.col("event_id").alias("request_id"), body.alias("body"))


def _forecasts(spark: SparkSession, folder: str) -> DataFrame:
    return requests.explode_requests(request_log(spark, folder)).where("is_forecast")


def _stations(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "events").select(F.col("user_id").cast("int").alias("station_id")).distinct()


def _validated(spark: SparkSession, folder: str) -> DataFrame:
    """Written once: the accepted and the refused side both read it."""
    return materialize(requests.validate(_forecasts(spark, folder), _stations(spark, folder)), "validated")


_DAY = "strftime(day, '%Y-%m-%d')"


@query("request_envelope", with_ctes(f"""
    SELECT request_id, CASE WHEN m IN (7, 8) THEN NULL ELSE 0 END AS position,
        CASE WHEN m IN (7, 8) THEN NULL WHEN m = 3 THEN '99999999' ELSE CAST(station_id AS VARCHAR) END AS station_id,
        CASE WHEN m IN (5, 7, 8, 11) THEN NULL WHEN m = 6 THEN '2024-02-30' ELSE {_DAY} END AS date,
        CASE WHEN m IN (7, 8) THEN NULL WHEN m = 4 THEN '24' ELSE CAST(hour AS VARCHAR) END AS hour,
        CASE m WHEN 7 THEN 'body must be a record or a non-empty list of records'
               WHEN 8 THEN 'body is not valid json' END AS body_error
    FROM requests
    UNION ALL
    SELECT request_id, 1, CAST(station_id AS VARCHAR), {_DAY},
        CASE WHEN m = 9 THEN '-1' ELSE CAST((hour + 1) % 24 AS VARCHAR) END, NULL
    FROM requests WHERE m IN (0, 1, 9)""", "requests"))
def request_envelope(spark: SparkSession, folder: str) -> DataFrame:
    exploded = requests.explode_requests(request_log(spark, folder))
    return exploded.select("request_id", "position", *[F.col("record")[f].alias(f) for f in ("station_id", "date", "hour")],
                           "body_error")


@query("request_validation", with_ctes("""
    SELECT request_id, 'rejected' AS outcome, CAST(NULL AS INT) AS position, CASE m
        WHEN 3 THEN 'unknown station_id: 99999999' WHEN 4 THEN 'hour must be 0-23, got 24'
        WHEN 5 THEN 'missing field: date' WHEN 6 THEN 'bad field: date'
        WHEN 7 THEN 'body must be a record or a non-empty list of records' WHEN 8 THEN 'body is not valid json'
        ELSE 'hour must be 0-23, got -1' END AS error
    FROM requests WHERE m IN (3, 4, 5, 6, 7, 8, 9) AND m <> 5
    UNION ALL SELECT request_id, 'accepted', position, NULL FROM good""", "requests", "good"))
def request_validation(spark: SparkSession, folder: str) -> DataFrame:
    checked = _validated(spark, folder)
    refused = requests.rejected(checked).select("request_id", F.lit("rejected").alias("outcome"),
                                                F.lit(None).cast("int").alias("position"), "error")
    passed = requests.accepted(checked).select("request_id", F.lit("accepted").alias("outcome"), "position",
                                               F.lit(None).cast("string").alias("error"))
    return refused.unionByName(passed)


# A record without a date and without a path is taken for a direct prediction.
@query("direct_requests", with_ctes("""
    SELECT request_id, station_id, hour, CASE WHEN m = 11 AND request_id // 12 % 2 = 1 THEN 'winter' END AS season,
        CASE WHEN m = 11 THEN 1.0::DOUBLE END AS hour_sin,
        CASE WHEN m = 5 THEN 'missing features: season, quarter, month, weekday, week_of_year, is_weekend, is_holiday, hour_sin, hour_cos, weekday_sin, weekday_cos, month_sin, month_cos, py_station_hour_weekday_mean, py_station_month_mean'
             WHEN request_id // 12 % 2 = 0 THEN 'missing features: season, month_cos' END AS error
    FROM requests WHERE m IN (5, 11)""", "requests"))
def direct_requests(spark: SparkSession, folder: str) -> DataFrame:
    routed = requests.explode_requests(request_log(spark, folder))
    given = requests.given_features(routed.where("not is_forecast"))
    return given.select("request_id", "station_id", "hour", "season", "hour_sin", "error")


def expanded(spark: SparkSession, folder: str, history: DataFrame) -> DataFrame:
    """Features of all accepted requests, with lookups from a history panel."""
    valid = requests.accepted(_validated(spark, folder))
    by_hour, by_month, default = requests.prior_lookups(history)
    by_hour, by_month = materialize(by_hour, "lookup"), materialize(by_month, "lookup")
    holidays = statutory_holidays(history.select("year").distinct())
    return requests.expand(valid, holidays, by_hour, by_month, default)


@query("expand_requests", with_ctes("""
    , hw AS (SELECT station_id, hour, weekday, round(avg(trip_count), 6) AS v FROM ev_cal_panel GROUP BY ALL),
    mo AS (SELECT station_id, month, round(avg(trip_count), 6) AS v FROM ev_cal_panel GROUP BY ALL),
    dflt AS (SELECT round(avg(trip_count), 6) AS v FROM ev_cal_panel),
    parts AS (SELECT *, CAST(dayofweek(start_date) + 1 AS INT) AS weekday, CAST(month(start_date) AS INT) AS month FROM good)
    SELECT request_id, position, start_date, g.station_id, g.hour, g.weekday, g.month,
        CASE WHEN g.month IN (12, 1, 2) THEN 'winter' ELSE 'spring' END AS season,
        CAST(quarter(start_date) AS INT) AS quarter, CAST(week(start_date) AS INT) AS week_of_year,
        CAST(g.weekday IN (1, 7) AS TINYINT) AS is_weekend,
        CAST(start_date IN (SELECT holiday FROM holidays) AS TINYINT) AS is_holiday,
        round(sin(2 * pi() * g.hour / 24), 6) + 0.0 AS hour_sin, round(cos(2 * pi() * g.hour / 24), 6) + 0.0 AS hour_cos,
        round(sin(2 * pi() * g.weekday / 7), 6) + 0.0 AS weekday_sin,
        round(cos(2 * pi() * g.weekday / 7), 6) + 0.0 AS weekday_cos,
        round(sin(2 * pi() * g.month / 12), 6) + 0.0 AS month_sin, round(cos(2 * pi() * g.month / 12), 6) + 0.0 AS month_cos,
        coalesce(hw.v, dflt.v) AS py_station_hour_weekday_mean, coalesce(mo.v, dflt.v) AS py_station_month_mean,
        hw.v IS NULL OR mo.v IS NULL AS default_used
    FROM parts g CROSS JOIN dflt
    LEFT JOIN hw ON hw.station_id = g.station_id AND hw.hour = g.hour AND hw.weekday = g.weekday
    LEFT JOIN mo ON mo.station_id = g.station_id AND mo.month = g.month""", "good", "ev_cal_panel", "holidays"))
def expand_requests(spark: SparkSession, folder: str) -> DataFrame:
    return expanded(spark, folder, materialize(event_panel(spark, folder), "history"))


@query("batch_forecast", with_ctes("""
    , cell AS (SELECT station_id, hour, weekday, quantile_cont(trip_count, 0.8) AS q FROM ev_cal_panel GROUP BY ALL)
    SELECT request_id, position,
        round(greatest(coalesce(q, (SELECT avg(trip_count) FROM ev_cal_panel)), 0), 4) AS prediction
    FROM good g LEFT JOIN cell c ON c.station_id = g.station_id AND c.hour = g.hour
        AND c.weekday = dayofweek(start_date) + 1""", "good", "ev_cal_panel"))
def batch_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted requests scored by the 80 % quantile cells."""
    history = materialize(event_panel(spark, folder), "history")
    cells = baseline.fit_cells(history, {"pred": baseline.quantile_of(0.8)}, CELL_KEYS)
    return requests.score(expanded(spark, folder, history), lambda df: baseline.predict_cells(df, cells, ["pred"]))
