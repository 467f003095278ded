"""Accuracy, cost and shape reports of the cell models, and the run records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.contract import TARGET
from tidewheel.functions.encoding import rounded
from tidewheel.operators import baseline, bootstrap, metrics
from tidewheel.queries.check_sql import with_ctes
from tidewheel.queries.registry import query
from tidewheel.queries.standins import BUSY, event_panel, week_split
from tidewheel.session import materialize, scratch_path
from tidewheel.sources import records

MODELS = {"baseline": None, "q50": 0.5, "q80": 0.8, "q90": 0.9}
LEVELS = {name: q for name, q in MODELS.items() if q}


def cell_models() -> dict:
    return {name: F.avg(TARGET) if q is None else baseline.quantile_of(q) for name, q in MODELS.items()}


def scored(spark: SparkSession, folder: str, zones: bool = True) -> DataFrame:
    """Tall predictions of all cell models on validation and test weeks."""
    split = week_split(spark, folder, zones)
    cells = baseline.fit_cells(split.where("split = 'train'"), cell_models())
    wide = baseline.predict_cells(split.where("split <> 'train'"), cells, list(MODELS))
    return baseline.tall_predictions(wide, list(MODELS), ["split", "station_id", "start_date", "hour", "is_weekend"])


def tests(spark: SparkSession, folder: str) -> DataFrame:
    return scored(spark, folder).where("split = 'test'")


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison."""
    return df.select(*[rounded(F.col(c), digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


ACCURACY_SQL = """round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
        round(avg(abs(y - p)) FILTER (hour IN (7, 8, 9, 16, 17, 18, 19)), 6) AS mae_peak,
        round(avg(abs(y - p)) FILTER (hour NOT IN (7, 8, 9, 16, 17, 18, 19)), 6) AS mae_offpeak,
        round(avg(abs(y - p)) FILTER (y >= 5), 6) AS mae_busy, round(avg(p - y) FILTER (y >= 5), 6) + 0.0 AS bias_busy"""


@query("accuracy_metrics", with_ctes(f"""
    SELECT split, model, {ACCURACY_SQL} FROM preds WHERE split <> 'train' GROUP BY ALL""", "preds"))
def accuracy_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return shown(metrics.accuracy(scored(spark, folder), ("split", "model"), busy=BUSY))


_COST = """avg(abs(y - p)) AS mae, avg(abs(y - p)) FILTER (hour IN (7, 8, 9, 16, 17, 18, 19)) AS mae_peak,
        avg(abs(y - p)) FILTER (y >= 5) AS mae_busy, avg((p < y)::INT) FILTER (y >= 5) AS under_rate_busy,
        1 - sum(p) FILTER (y >= 5) / sum(y) FILTER (y >= 5) AS shortfall_busy,
        avg(greatest(q * (y - p), (q - 1) * (y - p))) AS pinball, avg(greatest(p - y, 0)) AS over_supply,
        sum(greatest(y - p, 0)) AS unmet_demand, sum(greatest(p - y, 0)) AS over_supply_total,
        sum(greatest(y - p, 0)) / sum(y) AS unmet_pct, sum(greatest(p - y, 0)) / sum(y) AS over_pct"""
_COSTS = f""", costs AS (SELECT model, {_COST} FROM
        (SELECT *, CASE model WHEN 'q80' THEN 0.8 WHEN 'q90' THEN 0.9 ELSE 0.5 END AS q FROM tests) GROUP BY 1)"""


def test_costs(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.cost(tests(spark, folder), LEVELS, busy=BUSY)


@query("cost_metrics", with_ctes(_COSTS + """
    SELECT model, round(mae, 6) AS mae, round(mae_peak, 6) AS mae_peak, round(mae_busy, 6) AS mae_busy,
        round(under_rate_busy, 6) AS under_rate_busy, round(shortfall_busy, 6) + 0.0 AS shortfall_busy,
        round(pinball, 6) AS pinball, round(over_supply, 6) AS over_supply, round(unmet_demand, 6) AS unmet_demand,
        round(over_supply_total, 6) AS over_supply_total, round(unmet_pct, 6) AS unmet_pct, round(over_pct, 6) AS over_pct
    FROM costs""", "tests"))
def cost_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return shown(test_costs(spark, folder))


@query("model_comparison", with_ctes(f"""
    , s AS (SELECT model, {ACCURACY_SQL}, avg(abs(y - p)) AS raw_mae FROM tests GROUP BY 1)
    SELECT * EXCLUDE (raw_mae), round(1 - raw_mae / (SELECT raw_mae FROM s WHERE model = 'baseline'), 6) + 0.0 AS vs_baseline
    FROM s""", "tests"))
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return shown(metrics.compare(metrics.accuracy(tests(spark, folder), busy=BUSY), "baseline"))


@query("tradeoff", with_ctes(_COSTS + """
    SELECT c.model, round(c.mae, 6) AS mae, round(c.shortfall_busy, 6) + 0.0 AS shortfall_busy,
        round(c.under_rate_busy, 6) AS under_rate_busy, round(c.over_supply, 6) AS over_supply,
        round(c.mae / r.mae - 1, 6) + 0.0 AS mae_vs_reference,
        round(1 - c.shortfall_busy / r.shortfall_busy, 6) + 0.0 AS shortfall_closed,
        round(1 - c.unmet_pct / r.unmet_pct, 6) + 0.0 AS unmet_lower, round(c.over_pct / r.over_pct, 6) AS over_ratio
    FROM costs c, costs r WHERE r.model = 'baseline'""", "tests"))
def tradeoff(spark: SparkSession, folder: str) -> DataFrame:
    return shown(metrics.tradeoff(test_costs(spark, folder), "baseline"))


@query("decision_record", with_ctes(_COSTS + """
    SELECT c.model, c.model = 'q80' AS recommended, round(c.mae, 2) AS mae, round(100 * c.unmet_pct, 2) AS unmet_pct,
        round(100 * c.over_pct, 2) AS over_pct, round(100 * c.shortfall_busy, 2) + 0.0 AS busy_shortfall_pct,
        round(1 - c.unmet_pct / r.unmet_pct, 6) + 0.0 AS unmet_lower, round(c.over_pct / r.over_pct, 6) AS over_ratio
    FROM costs c, costs r WHERE r.model = 'baseline'""", "tests"))
def decision_record(spark: SparkSession, folder: str) -> DataFrame:
    return shown(metrics.decision(test_costs(spark, folder), "baseline", "q80"))


_BAND = """CASE WHEN y <= 0 THEN '0' WHEN y <= 2 THEN '1-2' WHEN y <= 5 THEN '3-5' WHEN y <= 10 THEN '6-10' ELSE '11+' END"""


@query("demand_bands", with_ctes(f"""
    SELECT model, {_BAND} AS band, count(*) AS row_count, round(avg(y), 6) AS mean_actual, round(avg(p), 6) AS mean_pred,
        round(avg(abs(y - p)), 6) AS mae, round(1 - avg(p) / nullif(avg(y), 0), 6) + 0.0 AS shortfall,
        round(sum(y) / sum(sum(y)) OVER (PARTITION BY model), 6) AS pct_of_trips
    FROM tests GROUP BY 1, 2""", "tests"))
def demand_bands(spark: SparkSession, folder: str) -> DataFrame:
    return shown(metrics.by_band(tests(spark, folder)))


_STATIONS = """SELECT model, station_id, sum(y) AS total_trips, avg(abs(y - p)) AS mae,
        1 - sum(p) / nullif(sum(y), 0) AS shortfall FROM tests GROUP BY ALL"""


@query("station_error", with_ctes(f"""
    SELECT model, station_id, total_trips, round(mae, 6) AS mae, round(shortfall, 6) + 0.0 AS shortfall
    FROM ({_STATIONS}) ORDER BY total_trips DESC, station_id, model LIMIT 10""", "tests"))
def station_error(spark: SparkSession, folder: str) -> DataFrame:
    """The ten busiest rows of the per-station report."""
    return shown(metrics.by_station(tests(spark, folder), 10))


@query("station_spread", with_ctes(f"""
    SELECT model, round(min(mae), 6) AS best_mae, round(quantile_cont(mae, 0.5), 6) AS median_mae,
        round(max(mae), 6) AS worst_mae, round(quantile_cont(shortfall, 0.5), 6) + 0.0 AS median_shortfall
    FROM ({_STATIONS}) GROUP BY 1""", "tests"))
def station_spread(spark: SparkSession, folder: str) -> DataFrame:
    return shown(metrics.station_spread(metrics.by_station(tests(spark, folder))))


@query("shortfall_histogram", with_ctes(f"""
    , s AS (SELECT shortfall AS v, min(shortfall) OVER () AS lo, max(shortfall) OVER () AS hi
            FROM ({_STATIONS}) WHERE model = 'q80')
    SELECT CAST(least(floor((v - lo) / (hi - lo) * 24), 23) AS INT) AS bin, count(*) AS row_count
    FROM s WHERE v IS NOT NULL GROUP BY 1""", "tests"))
def shortfall_histogram(spark: SparkSession, folder: str) -> DataFrame:
    stations = metrics.by_station(tests(spark, folder).where("model = 'q80'"))
    return metrics.histogram(stations, "shortfall", 24)


@query("hour_actual_vs_pred", with_ctes("""
    SELECT model, hour, round(avg(y), 6) AS actual, round(avg(p), 6) AS predicted FROM tests GROUP BY ALL""", "tests"))
def hour_actual_vs_pred(spark: SparkSession, folder: str) -> DataFrame:
    return shown(metrics.by_hour(tests(spark, folder)))


@query("unmet_by_hour", with_ctes("""
    SELECT model, hour, round(sum(greatest(y - p, 0)) / nullif(sum(y), 0), 6) AS unmet_share
    FROM tests WHERE hour BETWEEN 16 AND 19 GROUP BY ALL""", "tests"))
def unmet_by_hour(spark: SparkSession, folder: str) -> DataFrame:
    return shown(metrics.unmet_by_hour(tests(spark, folder)))


_PROFILE = """SELECT hour, avg(trip_count) FILTER (is_weekend = 0) AS weekday_mean,
        avg(trip_count) FILTER (is_weekend = 1) AS weekend_mean FROM ev_cal_panel GROUP BY 1"""


@query("hour_profile", with_ctes(f"""
    SELECT hour, round(weekday_mean, 6) AS weekday_mean, round(weekend_mean, 6) AS weekend_mean
    FROM ({_PROFILE})""", "ev_cal_panel"))
def hour_profile(spark: SparkSession, folder: str) -> DataFrame:
    return shown(metrics.hour_profile(event_panel(spark, folder)))


@query("peak_hours", with_ctes(f"""
    SELECT hour, round(weekday_mean, 6) AS weekday_mean
    FROM (SELECT * FROM ({_PROFILE}) ORDER BY weekday_mean DESC, hour LIMIT 3)""", "ev_cal_panel"))
def peak_hours(spark: SparkSession, folder: str) -> DataFrame:
    return shown(metrics.peak_hours(metrics.hour_profile(event_panel(spark, folder))))


@query("leaderboard", with_ctes(f"""
    , s AS (SELECT model, {ACCURACY_SQL}, avg(abs(y - p)) AS raw FROM preds WHERE split = 'val' GROUP BY 1)
    SELECT * EXCLUDE (raw), round(max(raw) OVER () / min(raw) OVER () - 1, 6) + 0.0 AS spread FROM s""", "preds"))
def leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    val = scored(spark, folder).where("split = 'val'")
    return shown(metrics.leaderboard(metrics.accuracy(val, busy=BUSY)))


@query("run_log", with_ctes("""
    SELECT run, split, unnest(['mae', 'rmse']) AS metric, unnest([mae, rmse]) AS value, 'station_hour_weekday' AS cell
    FROM (SELECT model AS run, split, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse
          FROM preds WHERE split <> 'train' AND model IN ('baseline', 'q80') GROUP BY ALL)""", "preds"))
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Append the scores of two runs to the record table and read all records."""
    path = scratch_path(spark, "runs")
    scores = metrics.accuracy(scored(spark, folder), ("split", "model"), busy=BUSY).select("split", "model", "mae", "rmse")
    for run in ("baseline", "q80"):
        rows = metrics.tall_metrics(scores.where(F.col("model") == run).drop("model"), ["split"])
        records.log_run(rows, path, run, {"cell": "station_hour_weekday"})
    return records.read_runs(spark, path).select(
        "run", "split", "metric", rounded(F.col("value")).alias("value"), F.col("params")["cell"].alias("cell"))


_STEPS = " ".join(f"WHEN {k} THEN len(list_filter({bootstrap.cumulative(2 ** k)}, lambda t: u >= t))" for k in range(6))


@query("bootstrap_ci", with_ctes(f"""
    , fitted AS (SELECT station_id, hour, weekday, avg(trip_count) AS a, quantile_cont(trip_count, 0.5) AS b
        FROM ev_split WHERE split = 'train' GROUP BY ALL),
    gaps AS (SELECT t.station_id, start_date, t.hour, abs(trip_count - a) AS ea, abs(trip_count - a) - abs(trip_count - b) AS d
        FROM ev_split t JOIN fitted f ON f.station_id = t.station_id AND f.hour = t.hour AND f.weekday = t.weekday
        WHERE split = 'test'),
    kinds AS (SELECT CAST(round(d * 1000000000) AS BIGINT) AS k, count(*) AS n FROM gaps GROUP BY 1),
    bits AS (SELECT k, bit FROM kinds, (SELECT unnest(range(0, 40)) AS bit) WHERE (n >> bit) & 1 = 1),
    digests AS (SELECT k, bit, block, concat_ws('|', '0', k, bit, block) AS t FROM bits, (SELECT unnest(range(0, 50)) AS block)),
    draws AS (SELECT k, bit, block * 4 + i AS replicate, CAST('0x' || substr(md5(t), CAST(1 + 8 * i AS INT), 8) AS BIGINT) AS u,
                  CAST('0x' || substr(md5(t || '|'), CAST(1 + 8 * i AS INT), 8) AS BIGINT) AS v
        FROM digests, (SELECT unnest(range(0, 4)) AS i)),
    weighted AS (SELECT replicate, k / 1000000000.0::DOUBLE AS d, CASE bit {_STEPS} ELSE greatest(0, floor(pow(2.0::DOUBLE, bit) + 0.5::DOUBLE
        + sqrt(pow(2.0::DOUBLE, bit)) * sqrt(-2 * ln((u + 0.5::DOUBLE) / 4294967296)) * cos(2 * pi() * v / 4294967296))) END AS w
        FROM draws),
    means AS (SELECT replicate, sum(w * d) / sum(w) AS gap FROM weighted GROUP BY 1)
    SELECT round((SELECT avg(d) FROM gaps), 6) + 0.0 AS mean_gap, round(quantile_cont(gap, 0.025), 6) + 0.0 AS low,
        round(quantile_cont(gap, 0.975), 6) + 0.0 AS high, count(*) AS replicates,
        round((SELECT avg(d) / avg(ea) FROM gaps), 6) + 0.0 AS relative_gap FROM means""", "ev_split"))
def bootstrap_ci(spark: SparkSession, folder: str) -> DataFrame:
    """Is the cell mean or the cell median better, beyond chance?"""
    test = scored(spark, folder, zones=False).where("split = 'test'")
    key = ["station_id", "start_date", "hour"]
    paired = test.groupBy(*key).agg(*[
        F.max(F.when(F.col("model") == m, F.abs(F.col("y") - F.col("pred")))).alias(m) for m in ("baseline", "q50")])
    return shown(bootstrap.paired_ci(materialize(paired, "paired"), "baseline", "q50"))
