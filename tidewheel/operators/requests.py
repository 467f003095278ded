"""Batches of forecast requests: decode, validate, expand to features, score."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.contract import CALENDAR_FEATURES, CYCLES, PRIOR_FEATURES, TARGET
from tidewheel.functions.calendar import calendar_columns
from tidewheel.functions.encoding import clipped, cyclical_columns, rounded
from tidewheel.functions.text import composite_key, single_spaced
from tidewheel.sources.records import to_lookup

# The texts a caller sees.
NOT_JSON = "body is not valid json"
EMPTY_BODY = "body must be a record or a non-empty list of records"


def explode_requests(requests: DataFrame, column: str = "body") -> DataFrame:
    """(request_id, is_forecast, position, record, texts, fields, body_error): one row per record.

    `texts` names the fields of the record that are JSON texts, and `fields` all that any record of the request has.

    The text is one record, a list of records, an object with `instances`, or a gateway
    event that carries any of these (as text or object) in `body`. A request without a
    record keeps one row with a null record.
    """
    event, payload = F.col(column), F.col("payload")
    path = F.coalesce(F.get_json_object(event, "$.rawPath"),
                      F.get_json_object(event, "$.requestContext.http.path"), F.lit(""))
    # one projection per step, so that each text is parsed once and not per use
    opened = requests.select(
        "request_id", path.alias("path"),
        F.trim(F.coalesce(F.get_json_object(event, "$.body"), event)).alias("payload"))
    inner = opened.withColumn("inner", F.when(~payload.startswith("["), F.get_json_object(payload, "$.instances")))
    as_list = (F.when(payload.startswith("["), payload)
               .otherwise(F.coalesce("inner", F.concat(F.lit("["), payload, F.lit("]")))))
    parsed = inner.select("request_id", "path", F.from_json(as_list, "array<map<string,variant>>").alias("records"))
    records = F.col("records")
    fields = F.array_distinct(F.flatten(F.transform(records, F.map_keys)))
    rows = parsed.select("request_id", _forecast_route(F.col("path"), F.get(records, F.lit(0))).alias("is_forecast"),
                         F.posexplode_outer(records).alias("position", "given"), fields.alias("fields"),
                         F.when(records.isNull(), NOT_JSON).when(F.size(records) == 0, EMPTY_BODY).alias("body_error"))
    given = F.col("given")
    is_text = F.map_filter(given, lambda _, v: F.schema_of_variant(v) == "STRING")
    return rows.select("request_id", "is_forecast", "position",
                       F.transform_values(given, lambda _, v: F.try_variant_get(v, "$", "string")).alias("record"),
                       F.map_keys(is_text).alias("texts"), "fields", "body_error")


def _forecast_route(path: Column, first_record: Column) -> Column:
    """Forecast by path, or by a date in the first record when the path does not say.

    A request without any record is refused on the forecast side.
    """
    dated = ~path.endswith("/predict") & F.map_contains_key(first_record, "date")
    return path.endswith("/forecast") | F.coalesce(dated, F.lit(True))


def _whole(name: str) -> Column:
    """A number without its fraction, or a text of digits; a text with a fraction is not a whole number."""
    value = F.col("record")[name]
    number = value.try_cast("double").try_cast("int")
    return F.when(~F.array_contains("texts", name) | value.rlike(r"^\s*[+-]?[0-9]+\s*$"), number)


def validate(records: DataFrame, stations: DataFrame) -> DataFrame:
    """Typed station_id, hour and start_date, with `error` where a record is unusable.

    Fields are judged in the order station, hour, date; known-station and range checks
    come after all fields could be read.
    """
    typed = records.withColumns({
        "station_id": _whole("station_id"), "hour": _whole("hour"),
        "start_date": F.when(F.col("record")["date"].rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"),
                             F.try_to_date(F.col("record")["date"], "yyyy-M-d"))})
    known = stations.select(F.col("station_id"), F.lit(True).alias("known_station")).distinct()
    error = F.when(F.col("record").isNull(), F.coalesce("body_error", F.lit(NOT_JSON)))
    for field, parsed in (("station_id", "station_id"), ("hour", "hour"), ("date", "start_date")):
        error = (error.when(~F.map_contains_key("record", field), F.lit(f"missing field: {field}"))
                 .when(F.col(parsed).isNull(), F.lit(f"bad field: {field}")))
    error = (error.when(F.col("known_station").isNull(), F.concat(F.lit("unknown station_id: "), "station_id"))
             .when(~F.col("hour").between(0, 23), F.concat(F.lit("hour must be 0-23, got "), "hour")))
    return typed.join(known, "station_id", "left").withColumn("error", error).select(
        "request_id", "position", "station_id", "start_date", "hour", "error")


def rejected(validated: DataFrame) -> DataFrame:
    """(request_id, error): a request fails as a whole with its first broken record."""
    return validated.where(F.col("error").isNotNull()).groupBy("request_id").agg(
        F.min_by("error", F.coalesce("position", F.lit(0))).alias("error"))


def accepted(validated: DataFrame) -> DataFrame:
    """The records of all requests without any broken record."""
    return (validated.join(rejected(validated).select("request_id"), "request_id", "left_anti")
            .drop("error"))


def prior_lookups(history: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """Hour-weekday and month lookups of a history panel, and the mean used as default."""
    mean = rounded(F.avg(TARGET))
    return (to_lookup(history, ["station_id", "hour", "weekday"], mean),
            to_lookup(history, ["station_id", "month"], mean),
            history.agg(mean).scalar())


def service_stations(pool: DataFrame, dim_station: DataFrame, history_year: int) -> DataFrame:
    """The station list the service offers, with the year it serves."""
    names = dim_station.select(F.col("dim_station_id").alias("station_id"),
                               single_spaced("dim_station_name").alias("station_name"))
    return (pool.select("station_id").distinct().join(names, "station_id", "left")
            .select("station_id", F.coalesce("station_name", F.col("station_id").cast("string")).alias("station_name"),
                    F.lit(history_year).alias("history_year"), F.lit(history_year + 1).alias("target_year"))
            .orderBy("station_id"))


def derived_features(records: DataFrame, holidays: DataFrame) -> DataFrame:
    """Calendar and rounded cyclical features of (start_date, hour).

    The holiday list holds a few dates per year, so it is safe to broadcast.
    """
    parts = calendar_columns(F.col("start_date"))
    marked = holidays.select(F.col("holiday").alias("start_date"), F.lit(1).alias("_holiday")).distinct()
    with_calendar = records.join(F.broadcast(marked), "start_date", "left").withColumns({
        "season": parts["season"], "quarter": parts["quarter"], "month": parts["month"],
        "weekday": parts["weekday"], "week_of_year": parts["week"],
        "is_weekend": parts["is_weekend"].cast("tinyint"),
        "is_holiday": F.coalesce("_holiday", F.lit(0)).cast("tinyint")}).drop("_holiday")
    return with_calendar.withColumns({n: rounded(c) for n, c in cyclical_columns(CYCLES).items()})


def expand(records: DataFrame, holidays: DataFrame, by_hour: DataFrame, by_month: DataFrame,
           default: Column) -> DataFrame:
    """All model features of accepted records.

    A key the lookups do not hold gets `default`, and says so in `default_used`, because
    a calendar month without history would otherwise be served silently.
    """
    frame = derived_features(records, holidays)
    for name, lookup, keys in ((PRIOR_FEATURES[0], by_hour, ("station_id", "hour", "weekday")),
                               (PRIOR_FEATURES[1], by_month, ("station_id", "month"))):
        frame = (frame.withColumn("_key", composite_key(*keys))
                 .join(lookup.select(F.col("key").alias("_key"), F.col("value").alias(name)), "_key", "left")
                 .drop("_key"))
    missing = F.col(PRIOR_FEATURES[0]).isNull() | F.col(PRIOR_FEATURES[1]).isNull()
    return frame.withColumn("default_used", missing).withColumns(
        {name: F.coalesce(name, default) for name in PRIOR_FEATURES}).select(
        "request_id", "position", "start_date", *CALENDAR_FEATURES, *PRIOR_FEATURES, "default_used")


def given_features(records: DataFrame) -> DataFrame:
    """Feature values of direct prediction records, with `error` where a request is unusable.

    A feature that no record of the request has is missing; where only some records lack it, theirs is null. A value
    that cannot be read as its feature's number is a bad field.
    """
    names = CALENDAR_FEATURES + PRIOR_FEATURES
    whole = {"station_id", "hour", "quarter", "month", "weekday", "week_of_year", "is_weekend", "is_holiday"}

    def value(name: str) -> Column:
        text = F.col("record")[name]
        if name == "season":
            return text
        return _whole(name) if name in whole else text.try_cast("double")

    absent = F.filter(F.array(*map(F.lit, names)), lambda n: ~F.array_contains("fields", n))
    error = (F.when(F.col("record").isNull(), F.coalesce("body_error", F.lit(NOT_JSON)))
             .when(F.size(absent) > 0, F.concat(F.lit("missing features: "), F.array_join(absent, ", "))))
    for name in names:
        error = error.when(F.col("record")[name].isNotNull() & value(name).isNull(), f"bad field: {name}")
    return records.select("request_id", "position", *[value(n).alias(n) for n in names], error.alias("error"))


def score(features: DataFrame, predict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Predictions clipped at zero and rounded to four places, in request order keys."""
    return predict(features).select("request_id", "position", rounded(clipped(F.col("pred")), 4).alias("prediction"))
