"""Fitted models.

Fits on all features have no SQL twin; fits on one feature have a closed form, and those queries check the same code.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.contract import BOOST_DEFAULT, BOOST_GRID, BOOST_SHIPPED, CALENDAR_FEATURES, PRIOR_FEATURES
from tidewheel.functions.encoding import rounded
from tidewheel.operators import metrics, models, requests
from tidewheel.queries import forecast
from tidewheel.queries.check_sql import with_ctes
from tidewheel.queries.evaluation import ACCURACY_SQL, shown
from tidewheel.queries.registry import query
from tidewheel.queries.standins import BUSY, event_panel, week_split
from tidewheel.session import materialize

FEATURES = CALENDAR_FEATURES + PRIOR_FEATURES
POISSON = models.BoostParams(**BOOST_DEFAULT)
SHIPPED = models.BoostParams("quantile", **BOOST_SHIPPED)


def _parts(spark: SparkSession, folder: str, zones: bool = False) -> dict[str, DataFrame]:
    frozen = week_split(spark, folder, zones)
    return {name: frozen.where(F.col("split") == name) for name in ("train", "val", "test")}


@query("poisson_glm_scores")
def poisson_glm_scores(spark: SparkSession, folder: str) -> DataFrame:
    part = _parts(spark, folder)
    glm = models.fit_poisson_glm(part["train"])
    return shown(metrics.accuracy(models.predictions({"poisson_glm": glm}, part["test"], ["hour"]), busy=BUSY))


@query("boosted_poisson_scores")
def boosted_poisson_scores(spark: SparkSession, folder: str) -> DataFrame:
    part = _parts(spark, folder)
    fitted = models.fit_boosted(part["train"], FEATURES, POISSON)
    return shown(metrics.accuracy(models.predictions({"boosted_poisson": fitted}, part["test"], ["hour"]), busy=BUSY))


@query("boosted_quantile_scores")
def boosted_quantile_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Three quantile models with the shipped one's parameters, grown together."""
    part = _parts(spark, folder)
    levels = {"q50": 0.5, "q80": 0.8, "q90": 0.9}
    grid = [replace(SHIPPED, quantile=q) for q in levels.values()]
    fitted = dict(zip(levels, models.fit_many(part["train"], FEATURES, grid)))
    return shown(metrics.cost(models.predictions(fitted, part["test"], ["hour"]), levels, busy=BUSY))


@query("sweep_and_refit")
def sweep_and_refit(spark: SparkSession, folder: str) -> DataFrame:
    """Rank the published candidates on validation, refit the winner, score test once."""
    return _swept(_parts(spark, folder), FEATURES, [models.BoostParams(**values) for values in BOOST_GRID])


def _swept(part: dict[str, DataFrame], features: list[str], grid: list[models.BoostParams]) -> DataFrame:
    ranked, winner = models.sweep(part["train"], part["val"], features, grid, BUSY)
    final = models.fit_boosted(part["train"], features, winner)
    test = metrics.accuracy(models.predictions({"final": final}, part["test"], ["hour"]), busy=BUSY)
    return shown(ranked.drop("spread").withColumn("split", F.lit("val"))
                 .unionByName(test.withColumn("split", F.lit("test"))))


@query("feature_ablation")
def feature_ablation(spark: SparkSession, folder: str) -> DataFrame:
    part = _parts(spark, folder)
    return shown(models.ablation(part["train"], part["val"], POISSON, busy=BUSY))


@query("permutation_importance")
def permutation_importance(spark: SparkSession, folder: str) -> DataFrame:
    """The eight features whose shuffling hurts most."""
    part = _parts(spark, folder)
    fitted = models.fit_boosted(part["train"], FEATURES, POISSON)
    return shown(models.permutation_importance(fitted, part["val"], ["station_id", "start_date", "hour"]).limit(8))


@query("boosted_batch_forecast")
def boosted_batch_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted requests scored by the shipped 80 % quantile model."""
    train = week_split(spark, folder, zones=False).where("split = 'train'")
    fitted = models.fit_boosted(train, FEATURES, SHIPPED)
    return requests.score(forecast.expanded(spark, folder, materialize(event_panel(spark, folder), "history")), fitted.predict)


# --- Closed forms ----------------------------------------------------------
# A tree over the hour alone has a leaf for every hour, and a round moves each hour's score by a Newton step.

_HOUR = models.BoostParams(learning_rate=0.3, rounds=8, min_samples_leaf=1)
_HOURS = """, hours AS (SELECT hour, avg(trip_count) AS m FROM wsplit WHERE split = 'train' GROUP BY hour),
    grid(model, rate, rounds) AS (VALUES {grid}),
    walk(model, rate, rounds, hour, n, s) AS (
        SELECT model, rate, rounds, hour, 0, (SELECT ln(avg(trip_count)) FROM wsplit WHERE split = 'train') FROM hours, grid
        UNION ALL
        SELECT model, rate, rounds, w.hour, n + 1, s + rate * (m / exp(s) - 1) FROM walk w JOIN hours h ON h.hour = w.hour
        WHERE n < rounds),
    levels AS (SELECT model, hour, exp(s) AS p FROM walk WHERE n = rounds),
    scored AS (SELECT split, model, w.hour, w.station_id, w.start_date, trip_count::DOUBLE AS y, p
               FROM wsplit w JOIN levels l ON l.hour = w.hour)"""


def _hourly(body: str, grid: str = "('hour', 0.3::DOUBLE, 8)", more: tuple = ()) -> str:
    return with_ctes(_HOURS.format(grid=grid) + body, "wsplit", *more).replace("WITH ", "WITH RECURSIVE ", 1)


@query("boosted_closed_form", _hourly("SELECT hour, round(p, 6) AS pred FROM levels"))
def boosted_closed_form(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of a Poisson model that knows the hour alone."""
    train = _parts(spark, folder, zones=True)["train"]
    fitted = models.fit_boosted(train, ["hour"], _HOUR)
    return fitted.predict(train.select("hour").distinct()).select("hour", rounded(F.col("pred")).alias("pred"))


@query("quantile_closed_form", with_ctes("""
    SELECT is_weekend, quantile_disc(trip_count, 0.5)::DOUBLE AS q50, quantile_disc(trip_count, 0.8)::DOUBLE AS q80,
           quantile_disc(trip_count, 0.9)::DOUBLE AS q90 FROM wsplit WHERE split = 'train' GROUP BY 1""", "wsplit"))
def quantile_closed_form(spark: SparkSession, folder: str) -> DataFrame:
    """One round of quantile trees with a leaf for working days and one for weekends: the quantiles of their counts."""
    train = _parts(spark, folder, zones=True)["train"]
    levels = {"q50": 0.5, "q80": 0.8, "q90": 0.9}
    grid = [models.BoostParams("quantile", q, 1.0, 1, 2, min_samples_leaf=1) for q in levels.values()]
    out = train.select("is_weekend").distinct()
    for name, model in zip(levels, models.fit_many(train, ["is_weekend"], grid)):
        out = model.predict(out).withColumnRenamed("pred", name)
    return out


_SWEEP = [replace(_HOUR, learning_rate=rate, rounds=rounds) for rate in (0.05, 0.1, 0.2, 0.3) for rounds in (2, 4)]
_SWEEP_SQL = ", ".join(f"('cand_{i:02d}', {p.learning_rate}::DOUBLE, {p.rounds})" for i, p in enumerate(_SWEEP))


@query("sweep_closed_form", _hourly(f""",
    board AS (SELECT model, {ACCURACY_SQL} FROM scored WHERE split = 'val' GROUP BY model),
    winner AS (SELECT model FROM scored WHERE split = 'val' GROUP BY model ORDER BY avg(abs(y - p)), model LIMIT 1)
    SELECT *, 'val' AS split FROM board UNION ALL BY NAME
    SELECT 'final' AS model, {ACCURACY_SQL}, 'test' AS split FROM scored
    WHERE split = 'test' AND model = (SELECT model FROM winner)""", _SWEEP_SQL))
def sweep_closed_form(spark: SparkSession, folder: str) -> DataFrame:
    """Eight candidates that know the hour alone, grown together; the winner refitted and scored on test."""
    return _swept(_parts(spark, folder, zones=True), ["hour"], _SWEEP)


@query("ablation_closed_form", _hourly(f""",
    tall AS (SELECT model, hour, y, p FROM scored WHERE split = 'val'
             UNION ALL SELECT model, hour, y, p FROM preds WHERE split = 'val' AND model = 'baseline'),
    board AS (SELECT model, {ACCURACY_SQL}, avg(abs(y - p)) AS raw FROM tall GROUP BY model)
    SELECT * EXCLUDE (raw), round(1 - raw / (SELECT raw FROM board WHERE model = 'baseline'), 6) AS vs_baseline
    FROM board""", more=("preds",)))
def ablation_closed_form(spark: SparkSession, folder: str) -> DataFrame:
    """The cell means against a model that knows the hour alone."""
    part = _parts(spark, folder, zones=True)
    return shown(models.ablation(part["train"], part["val"], _HOUR, {"hour": ["hour"]}, BUSY))


@query("importance_closed_form", _hourly(""",
    keyed AS (SELECT hour, y, p, md5('0|' || station_id || '|' || strftime(start_date, '%Y-%m-%d') || '|' || hour) AS place,
                     (SELECT greatest(1, ceil(count(*) / 65536.0))::BIGINT FROM scored WHERE split = 'val') AS blocks
              FROM scored WHERE split = 'val'),
    dealt AS (SELECT *, list_reduce(list_transform(string_split(substr(place, 1, 8), ''),
                               lambda c: (instr('0123456789abcdef', c) - 1)::BIGINT), lambda a, b: a * 16 + b) % blocks AS block
              FROM keyed),
    ordered AS (SELECT *, row_number() OVER (PARTITION BY block ORDER BY place) - 1 AS at,
                       count(*) OVER (PARTITION BY block) AS n FROM dealt),
    moved AS (SELECT r, avg(abs(a.y - b.p)) AS mae FROM ordered a, (SELECT unnest([1, 2, 3]) AS r)
              JOIN ordered b ON b.block = a.block AND b.at = (a.at + r) % a.n GROUP BY r)
    SELECT 'hour' AS feature, round(avg(mae) - (SELECT avg(abs(y - p)) FROM ordered), 6) AS mae_increase FROM moved
    UNION ALL SELECT 'quarter', 0.0::DOUBLE"""))
def importance_closed_form(spark: SparkSession, folder: str) -> DataFrame:
    """What shuffling the hour costs a model of the hour, beside a feature that never changes."""
    part = _parts(spark, folder, zones=True)
    fitted = models.fit_boosted(part["train"], ["hour", "quarter"], _HOUR)
    return shown(models.permutation_importance(fitted, part["val"], ["station_id", "start_date", "hour"]))


_RIDGE = 0.01


@query("poisson_station_effects", with_ctes(f""",
    stations AS (SELECT station_id, count(*)::DOUBLE AS n, avg(trip_count) AS m FROM ev_split WHERE split = 'train' GROUP BY 1),
    total AS (SELECT sum(n) AS n, ln(sum(n * m) / sum(n)) AS b0 FROM stations),
    newton(station_id, i, b, s) AS (
        SELECT station_id, 0, b0, 0.0::DOUBLE FROM stations, total
        UNION ALL
        SELECT station_id, i + 1, b + slope / curve, s + (g - c * slope / curve) / d
        FROM (SELECT *, sum(n * m - c - c * g / d) OVER () AS slope, sum(c - c * c / d) OVER () AS curve
              FROM (SELECT w.station_id, i, b, s, x.n, x.m, x.n * exp(b + s) AS c, x.n * exp(b + s) + {_RIDGE} * total.n AS d,
                           x.n * (x.m - exp(b + s)) - {_RIDGE} * total.n * s AS g
                    FROM newton w JOIN stations x ON x.station_id = w.station_id, total WHERE i < 25)))
    SELECT station_id, round(exp(b + s), 6) AS pred FROM newton WHERE i = 25""", "ev_split").replace(
        "WITH ", "WITH RECURSIVE ", 1))
def poisson_station_effects(spark: SparkSession, folder: str) -> DataFrame:
    """The penalised regression on real stations alone, from its score equations."""
    train = _parts(spark, folder)["train"]
    glm = models.fit_poisson_glm(train, ["station_id"], alpha=_RIDGE)
    return glm.predict(train.select("station_id").distinct()).select("station_id", rounded(F.col("pred")).alias("pred"))
