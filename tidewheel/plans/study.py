"""Exported star -> station pool, panel, features, frozen split, models, verdict."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.contract import BUSY_THRESHOLD, POOL_TOP_N, STAR_COLUMNS, TARGET
from tidewheel.operators import baseline, bootstrap, features, metrics, models, panel, pool, splits
from tidewheel.plans.warehouse import require_ok
from tidewheel.session import materialize
from tidewheel.sources import exports, records, tables


@dataclass(frozen=True)
class StudyScope:
    """Which trips are studied, and how years are assigned."""

    first_by: str
    last_from: str
    periods: dict[str, list[int]] = field(default_factory=dict)
    user_type: str | None = None
    top_n: int = POOL_TOP_N

    @property
    def years(self) -> list[int]:
        return sorted(y for ys in self.periods.values() for y in ys)


# Scope of the published annual-member study.
ANNUAL = StudyScope("2019-01-31", "2022-12-01", {"train": [2019, 2020], "val": [2021], "test": [2022]}, "annual")
ALL_USERS = StudyScope("2019-01-31", "2023-12-01", {"train": [2019, 2020, 2021], "val": [2022], "test": [2023]})


def scoped_trips(star: dict[str, DataFrame], scope: StudyScope) -> DataFrame:
    fact = star["fact_trip"]
    if scope.user_type is not None:
        return pool.segment(fact, star["dim_user_type"], scope.user_type, scope.years)
    return pool.departures(fact.where(F.col("start_year").isin(scope.years)))


def prepare(spark: SparkSession, export: str, out: str, scope: StudyScope) -> dict[str, DataFrame]:
    """Write pool, cleaned trips, features and split; every write is read back."""
    star = exports.read_export(spark, export, list(STAR_COLUMNS))
    trips = scoped_trips(star, scope)
    daily = materialize(panel.daily_counts(trips), "daily")

    tables.write_small(pool.station_pool(pool.yearly_activity(daily), star["dim_station"], scope.first_by,
                                         scope.last_from, scope.top_n), f"{out}/station_pool")
    stations = tables.read_table(spark, f"{out}/station_pool")
    tables.write_partitioned(pool.keep_pool(trips, stations), f"{out}/cleaned", ["year"])
    cleaned = tables.read_table(spark, f"{out}/cleaned")

    days = panel.day_panel(stations, daily)
    counts = panel.unfold(days)
    tables.write_partitioned(features.featured(days, star["dim_date"]), f"{out}/featured", ["year"], gather=False)
    featured = tables.read_table(spark, f"{out}/featured")
    require_ok(panel.panel_checks(counts, cleaned, featured), "panel")
    require_ok(features.prior_year_checks(featured), "prior year")

    tables.write_partitioned(splits.split_by_period(featured, scope.periods), f"{out}/split", ["split"], gather=False)
    split = tables.read_table(spark, f"{out}/split")
    require_ok(splits.split_checks(split, counts, list(scope.periods)), "split")

    scores = metrics.accuracy(baseline_predictions(split, ["val"]))
    splits.split_contract(split, scope.periods, scope.user_type or "all", scores.select("mae"),
                          "boosted_poisson").coalesce(1).write.mode("overwrite").json(f"{out}/contract")
    return {"pool": stations, "cleaned": cleaned, "featured": featured, "split": split}


def baseline_predictions(split: DataFrame, parts: list[str]) -> DataFrame:
    """Cell means of the training rows on the given parts, with the global fallback."""
    cells = baseline.fit_cells(split.where("split = 'train'"), {"baseline": F.avg(TARGET)})
    scored = baseline.predict_cells(split.where(F.col("split").isin(parts)), cells, ["baseline"])
    return baseline.tall_predictions(scored, ["baseline"], ["split", "station_id", "start_date", "hour", "is_weekend"])


class BrokenSplit(ValueError):
    """The frozen split does not keep its contract."""


def checked_split(spark: SparkSession, out: str) -> tuple[dict, DataFrame]:
    """The contract and the frozen split, refused if parts overlap in time or columns are missing."""
    contract, split = read_contract(spark, out), tables.read_table(spark, f"{out}/split")
    absent = sorted(set(contract["features"] + [contract["target"]]) - set(split.columns))
    if absent:
        raise BrokenSplit(f"columns missing from the split: {absent}")
    bounds = {r["split"]: (r["lo"], r["hi"]) for r in split.groupBy("split").agg(
        F.min("start_date").alias("lo"), F.max("start_date").alias("hi")).collect()}
    if missing := sorted({"train", "val", "test"} - set(bounds)):
        raise BrokenSplit(f"parts without rows: {missing}")
    for earlier, later in (("train", "val"), ("val", "test")):
        if bounds[earlier][1] >= bounds[later][0]:
            raise BrokenSplit(f"{earlier} and {later} overlap")
    return contract, split


def provenance(contract: dict, train_rows: DataFrame) -> dict[str, str]:
    """What a run was trained on: features, target, test years, and a digest of the training rows."""
    columns = [*contract["features"], contract["target"], "start_date"]
    digest = records.fingerprint(train_rows, columns).first()
    return {"features": ",".join(contract["features"]), "target": contract["target"],
            "test_years": ",".join(map(str, contract["test_years"])), "train_rows": str(digest["row_count"]),
            "train_digest": f"{digest['xor_digest']}:{digest['sum_digest']}"}


def train(spark: SparkSession, out: str, name: str, params: models.BoostParams) -> DataFrame:
    """Fit on the training part as the contract says, score test, keep the model and its run record."""
    contract, split = checked_split(spark, out)
    rows = split.where("split = 'train'")
    model = models.fit_many(rows, contract["features"], [params], target=contract["target"])[0]
    models.save(model, spark, f"{out}/models/{name}")
    test = models.predictions({name: model}, split.where("split = 'test'"), ["hour"])
    level = params.quantile if params.loss == "quantile" else 0.5
    scores = metrics.cost(test, {name: level}, contract["peak_hours"], contract["busy_threshold"])
    scores = materialize(scores.withColumn("split", F.lit("test")), "scores")
    records.log_run(metrics.tall_metrics(scores.drop("model"), ["split"]), f"{out}/runs", name,
                    {**{k: str(v) for k, v in asdict(params).items()}, **provenance(contract, rows)})
    return scores


def sweep(spark: SparkSession, out: str, name: str, grid: list[models.BoostParams]) -> DataFrame:
    """Grow all candidates together, rank them on validation, train the winner as `name`; the board stays in the reports."""
    contract, split = checked_split(spark, out)
    board, winner = models.sweep(split.where("split = 'train'"), split.where("split = 'val'"), contract["features"], grid,
                                 contract["busy_threshold"])
    described = split.sparkSession.createDataFrame(
        [(f"cand_{i:02d}", json.dumps(asdict(p))) for i, p in enumerate(grid)], "model string, params string")
    board = _report(board.join(described, "model"), out, "sweep")
    train(spark, out, name, winner)
    return board.orderBy("mae", "model")


def regression(spark: SparkSession, out: str, alpha: float = 1.0) -> DataFrame:
    """Accuracy of the Poisson regression on validation and test, against the cell means."""
    contract, split = checked_split(spark, out)
    names = [f for f in contract["features"] if f not in contract["prior_year"]]
    fitted = models.fit_poisson_glm(split.where("split = 'train'"), names, alpha)
    tall = models.predictions({"poisson_glm": fitted}, split.where("split <> 'train'"), ["split", "hour"])
    cells = baseline_predictions(split, ["val", "test"]).select("split", "hour", "y", "model", "pred")
    scores = metrics.accuracy(tall.unionByName(cells), ("split", "model"), contract["peak_hours"], contract["busy_threshold"])
    return _report(scores, out, "regression").orderBy("split", "model")


def ablation(spark: SparkSession, out: str, params: models.BoostParams) -> DataFrame:
    """The cell means and the learner without and with the prior-year features, on validation."""
    contract, split = checked_split(spark, out)
    calendar = [f for f in contract["features"] if f not in contract["prior_year"]]
    board = models.ablation(split.where("split = 'train'"), split.where("split = 'val'"), params,
                            {"calendar": calendar, "calendar+py": contract["features"]}, contract["busy_threshold"])
    return _report(board, out, "ablation").orderBy("model")


def importance(spark: SparkSession, out: str, name: str, repeats: int = 3) -> DataFrame:
    """What shuffling each feature costs a saved model on validation."""
    split = checked_split(spark, out)[1]
    model = models.load(spark, f"{out}/models/{name}")
    board = models.permutation_importance(model, split.where("split = 'val'"), ["station_id", "start_date", "hour"], repeats)
    return _report(board, out, "importance").orderBy(F.desc("mae_increase"), "feature")


def interval(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Bootstrap interval of a saved model's gain over the cell means on test."""
    split, key = tables.read_table(spark, f"{out}/split"), ["station_id", "start_date", "hour"]
    tall = models.predictions({name: models.load(spark, f"{out}/models/{name}")}, split.where("split = 'test'"), key)
    cells = baseline_predictions(split, ["test"]).select(*key, "y", "model", "pred")
    wide = tall.unionByName(cells).groupBy(*key).agg(*[
        F.max(F.when(F.col("model") == m, F.abs(F.col("y") - F.col("pred")))).alias(a)
        for a, m in (("before", "baseline"), ("after", name))])
    return _report(bootstrap.paired_ci(materialize(wide, "paired"), "before", "after"), out, "interval")


def _report(df: DataFrame, out: str, name: str) -> DataFrame:
    """A report, written below `out` and read back."""
    tables.write_small(df, f"{out}/reports/{name}")
    return tables.read_table(df.sparkSession, f"{out}/reports/{name}")


def evaluate(spark: SparkSession, out: str, names: list[str], quantiles: dict[str, float], reference: str,
             recommended: str) -> dict[str, DataFrame]:
    """All reports on the test part for saved models and the baseline."""
    split = tables.read_table(spark, f"{out}/split")
    test, keep = split.where("split = 'test'"), ["split", "station_id", "start_date", "hour", "is_weekend"]
    saved = {name: models.load(spark, f"{out}/models/{name}") for name in names}
    tall = materialize(models.predictions(saved, test, keep).unionByName(baseline_predictions(split, ["test"])), "tall")
    costs = materialize(metrics.cost(tall, quantiles), "costs")
    return {
        "accuracy": metrics.compare(metrics.accuracy(tall, busy=BUSY_THRESHOLD), "baseline"),
        "costs": costs, "tradeoff": metrics.tradeoff(costs, reference),
        "verdict": metrics.decision(costs, reference, recommended),
        "bands": metrics.by_band(tall), "stations": metrics.by_station(tall),
        "hours": metrics.by_hour(tall), "unmet": metrics.unmet_by_hour(tall),
        "profile": metrics.hour_profile(test),
    }


def read_contract(spark: SparkSession, out: str) -> dict:
    """The one-row contract as plain values."""
    return json.loads(spark.read.text(f"{out}/contract").first()["value"])
