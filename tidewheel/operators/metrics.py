"""Accuracy and cost metrics over tall predictions (hour, y, model, pred)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewheel.contract import BUSY_THRESHOLD, PEAK_HOURS, TARGET
from tidewheel.functions.encoding import clipped, demand_band

def _y() -> Column:
    return F.col("y")


def _p() -> Column:
    return F.col("p")


def _scored(df: DataFrame) -> DataFrame:
    """Every metric works on predictions clipped at zero."""
    return df.withColumn("p", clipped(F.col("pred")))


def _mae(where: Column | None = None) -> Column:
    error = F.abs(_y() - _p())
    return F.avg(error if where is None else F.when(where, error))


def _shortfall(where: Column) -> Column:
    return 1 - F.try_divide(F.sum(F.when(where, _p())), F.sum(F.when(where, _y())))


def _pinball(q: Column) -> Column:
    gap = _y() - _p()
    return F.avg(F.greatest(q * gap, (q - 1) * gap))


def accuracy(df: DataFrame, by: tuple = ("model",), peak: list[int] = PEAK_HOURS,
             busy: int = BUSY_THRESHOLD) -> DataFrame:
    """MAE, RMSE, peak, off-peak, busy MAE and busy bias, all in one aggregate.

    A group without peak or busy rows gets a null there.
    """
    at_peak, at_busy = F.col("hour").isin(peak), _y() >= busy
    return _scored(df).groupBy(*by).agg(
        _mae().alias("mae"), F.sqrt(F.avg((_y() - _p()) * (_y() - _p()))).alias("rmse"),
        _mae(at_peak).alias("mae_peak"), _mae(~at_peak).alias("mae_offpeak"),
        _mae(at_busy).alias("mae_busy"), F.avg(F.when(at_busy, _p() - _y())).alias("bias_busy"))


def cost(df: DataFrame, quantiles: dict[str, float], peak: list[int] = PEAK_HOURS,
         busy: int = BUSY_THRESHOLD) -> DataFrame:
    """What the errors mean for operations; pinball uses each model's own quantile."""
    at_peak, at_busy = F.col("hour").isin(peak), _y() >= busy
    over, under = F.greatest(_p() - _y(), F.lit(0.0)), F.greatest(_y() - _p(), F.lit(0.0))
    q = F.lit(0.5)
    for model, level in quantiles.items():
        q = F.when(F.col("model") == model, level).otherwise(q)
    return _scored(df).withColumn("q", q).groupBy("model").agg(
        _mae().alias("mae"), _mae(at_peak).alias("mae_peak"), _mae(at_busy).alias("mae_busy"),
        F.avg(F.when(at_busy, (_p() < _y()).cast("double"))).alias("under_rate_busy"),
        _shortfall(at_busy).alias("shortfall_busy"), _pinball(F.col("q")).alias("pinball"),
        F.avg(over).alias("over_supply"), F.sum(under).alias("unmet_demand"),
        F.sum(over).alias("over_supply_total"),
        F.try_divide(F.sum(under), F.sum(_y())).alias("unmet_pct"),
        F.try_divide(F.sum(over), F.sum(_y())).alias("over_pct"))


def _at_reference(reference: str, metric: str) -> Column:
    """A metric of the reference model on every row.

    Score frames hold one row per model, so this window is over a handful of rows.
    """
    return F.max(F.when(F.col("model") == reference, F.col(metric))).over(Window.partitionBy())


def compare(scores: DataFrame, reference: str, metric: str = "mae", name: str = "vs_baseline") -> DataFrame:
    """Relative improvement over a reference model."""
    return scores.withColumn(name, 1 - F.try_divide(F.col(metric), _at_reference(reference, metric)))


def _trade(reference: str) -> dict[str, Column]:
    def ratio(metric: str) -> Column:
        return F.try_divide(F.col(metric), _at_reference(reference, metric))

    return {"mae_vs_reference": ratio("mae") - 1, "shortfall_closed": 1 - ratio("shortfall_busy"),
            "unmet_lower": 1 - ratio("unmet_pct"), "over_ratio": ratio("over_pct")}


def tradeoff(costs: DataFrame, reference: str) -> DataFrame:
    """What each model gives and takes against the reference model."""
    return costs.select("model", "mae", "shortfall_busy", "under_rate_busy", "over_supply",
                        *[c.alias(n) for n, c in _trade(reference).items()])


def decision(costs: DataFrame, reference: str, recommended: str) -> DataFrame:
    """The recorded choice: headline percentages of every model and the recommendation."""
    trade = _trade(reference)
    return costs.select(
        "model", (F.col("model") == recommended).alias("recommended"), F.round("mae", 2).alias("mae"),
        F.round(100 * F.col("unmet_pct"), 2).alias("unmet_pct"),
        F.round(100 * F.col("over_pct"), 2).alias("over_pct"),
        F.round(100 * F.col("shortfall_busy"), 2).alias("busy_shortfall_pct"),
        *[trade[n].alias(n) for n in ("unmet_lower", "over_ratio")])


def by_band(df: DataFrame) -> DataFrame:
    """Error by level of actual demand, per model.

    The share of all trips is taken over the band totals, so over five rows per model.
    """
    bands = _scored(df).groupBy("model", demand_band(_y()).alias("band")).agg(
        F.count("*").alias("row_count"), F.avg(_y()).alias("mean_actual"), F.avg(_p()).alias("mean_pred"),
        _mae().alias("mae"), F.sum(_y()).alias("trips"))
    all_trips = F.sum("trips").over(Window.partitionBy("model"))
    return bands.select("model", "band", "row_count", "mean_actual", "mean_pred", "mae",
                        (1 - F.try_divide("mean_pred", "mean_actual")).alias("shortfall"),
                        F.try_divide(F.col("trips"), all_trips).alias("pct_of_trips"))


def by_station(df: DataFrame, k: int | None = None) -> DataFrame:
    """Trips, MAE and shortfall per model and station, busiest first."""
    stations = _scored(df).groupBy("model", "station_id").agg(
        F.sum(_y()).alias("total_trips"), _mae().alias("mae"),
        (1 - F.try_divide(F.sum(_p()), F.sum(_y()))).alias("shortfall"))
    ordered = stations.orderBy(F.desc("total_trips"), "station_id", "model")
    return ordered if k is None else ordered.limit(k)


def station_spread(stations: DataFrame) -> DataFrame:
    """Best, median and worst station MAE and the median shortfall, per model."""
    return stations.groupBy("model").agg(
        F.min("mae").alias("best_mae"), F.percentile("mae", 0.5).alias("median_mae"),
        F.max("mae").alias("worst_mae"), F.percentile("shortfall", 0.5).alias("median_shortfall"))


def by_hour(df: DataFrame) -> DataFrame:
    """Mean actual and predicted demand per hour and model."""
    return _scored(df).groupBy("model", "hour").agg(F.avg(_y()).alias("actual"), F.avg(_p()).alias("predicted"))


def unmet_by_hour(df: DataFrame, first: int = 16, last: int = 19) -> DataFrame:
    """Share of trips a stock at the prediction would not serve, for a slice of hours."""
    unmet = F.try_divide(F.sum(F.greatest(_y() - _p(), F.lit(0.0))), F.sum(_y()))
    return (_scored(df).where(F.col("hour").between(first, last))
            .groupBy("model", "hour").agg(unmet.alias("unmet_share")))


def hour_profile(panel: DataFrame) -> DataFrame:
    """Mean departures per hour, weekdays beside weekends."""
    return (panel.groupBy("hour").pivot("is_weekend", [0, 1]).agg(F.avg(TARGET))
            .withColumnsRenamed({"0": "weekday_mean", "1": "weekend_mean"}).orderBy("hour"))


def peak_hours(profile: DataFrame, k: int = 3) -> DataFrame:
    """The k busiest weekday hours."""
    return profile.orderBy(F.desc("weekday_mean"), "hour").limit(k).select("hour", "weekday_mean")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and largest value; empty bins are left out."""
    bounds = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    position = F.floor(F.try_divide(F.col(column) - lo, hi - lo) * bins)
    bin_no = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (df.where(F.col(column).isNotNull()).groupBy(bin_no.alias("bin")).agg(F.count("*").alias("row_count"))
            .orderBy("bin"))


def busiest_slice(df: DataFrame, first: str, last: str) -> DataFrame:
    """The hours of one period at the station with most trips, in order."""
    totals = df.groupBy("station_id").agg(F.sum(TARGET).alias("n"))
    busiest = totals.agg(F.max_by("station_id", F.struct("n", -F.col("station_id")))).scalar()
    return (df.where((F.col("station_id") == busiest)
                     & F.col("start_date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))
            .orderBy("start_date", "hour"))


def tall_metrics(scores: DataFrame, ids: list[str]) -> DataFrame:
    """(ids.., metric, value), the form run records are kept in."""
    names = [c for c in scores.columns if c not in ids]
    return scores.unpivot(ids, names, "metric", "value")


def leaderboard(scores: DataFrame) -> DataFrame:
    """Candidates by validation MAE; the first row wins. Carries the relative spread.

    One row per candidate, so the window and the sort are over a handful of rows.
    """
    everyone = Window.partitionBy()
    spread = F.try_divide(F.max("mae").over(everyone), F.min("mae").over(everyone)) - 1
    return scores.withColumn("spread", spread).orderBy("mae", "model")
