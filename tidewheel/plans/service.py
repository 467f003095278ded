"""Request batches -> forecasts and refusals, with lookups of the last known year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.contract import STAR_COLUMNS
from tidewheel.functions.calendar import statutory_holidays
from tidewheel.operators import models, requests
from tidewheel.session import materialize
from tidewheel.sources import exports, records, tables


def build_lookups(spark: SparkSession, out: str, export: str, history_year: int) -> None:
    """Write both lookups, the default and the station list as JSON."""
    history = tables.read_table(spark, f"{out}/featured").where(F.col("year") == history_year)
    by_hour, by_month, default = requests.prior_lookups(history)
    records.write_lookup(by_hour, f"{out}/service/hour_weekday")
    records.write_lookup(by_month, f"{out}/service/month")
    spark.range(1).select(default.alias("default_mean")).coalesce(1).write.mode("overwrite").json(f"{out}/service/default")
    dims = exports.read_export(spark, export, [t for t in STAR_COLUMNS if t == "dim_station"])
    stations = requests.service_stations(history, dims["dim_station"], history_year)
    stations.write.mode("overwrite").json(f"{out}/service/stations")


def forecast(spark: SparkSession, out: str, name: str, batch: DataFrame,
             holidays: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(predictions, refusals) for a (request_id, body) batch.

    Forecast requests are expanded from station, date and hour; direct requests bring
    their features along. Both go through the same saved model. Give `holidays` when the
    warehouse was built with a holiday table of its own.
    """
    base = f"{out}/service"
    stations = spark.read.schema("station_id int, station_name string").json(f"{base}/stations")
    default = spark.read.schema("default_mean double").json(f"{base}/default").scalar()
    model = models.load(spark, f"{out}/models/{name}")

    records_of = requests.explode_requests(batch)
    checked = materialize(requests.validate(records_of.where("is_forecast"), stations), "validated")
    accepted = requests.accepted(checked)
    if holidays is None:  # the rule that dim_date is built with
        holidays = statutory_holidays(accepted.select(F.year("start_date").alias("year")).distinct())
    expanded = requests.expand(
        accepted, holidays, records.read_lookup(spark, f"{base}/hour_weekday"), records.read_lookup(spark, f"{base}/month"), default)
    given = materialize(requests.given_features(records_of.where("not is_forecast")), "given")
    predictions = requests.score(expanded, model.predict).unionByName(
        requests.score(requests.accepted(given), model.predict))
    return predictions, requests.rejected(checked).unionByName(requests.rejected(given))
