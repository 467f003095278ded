from __future__ import annotations

import math
import time
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.contract import CALENDAR_FEATURES, PRIOR_FEATURES
from tidewheel.operators import metrics, models, quantiles

FEATURES = CALENDAR_FEATURES + PRIOR_FEATURES
SMALL = models.BoostParams(rounds=6, depth=3, learning_rate=0.5, min_samples_leaf=5)


@pytest.fixture(scope="module")
def frame(spark):
    """Counts that depend on the hour and the station only; no history for half the rows."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(2400):
        station, hour = i % 4, i // 4 % 24
        level = (1 + station) * (4.0 if hour in (8, 17) else 0.5)
        rows.append((i, station, "summer" if i % 2 else "winter", hour, float(level), int(rng.poisson(level))))
    df = spark.createDataFrame(rows, "row int, station_id int, season string, hour int, level double, trip_count bigint")
    other = {c: F.lit(1) for c in ("quarter", "month", "weekday", "week_of_year", "is_weekend", "is_holiday")}
    waves = {c: F.lit(0.0) for c in CALENDAR_FEATURES if c.endswith(("_sin", "_cos"))}
    prior = {c: F.when(F.col("row") % 2 == 0, F.lit(None).cast("double")).otherwise(1.0) for c in PRIOR_FEATURES}
    return df.withColumns({**other, **waves, **prior}).cache()


def mae(df):
    return df.agg(F.avg(F.abs(F.col("trip_count") - F.col("pred")))).first()[0]


def test_poisson_boosting_finds_the_rate(frame):
    fitted = models.fit_boosted(frame, FEATURES, replace(SMALL, rounds=12))
    scored = fitted.predict(frame)
    flat = frame.withColumn("pred", F.lit(frame.agg(F.avg("trip_count")).first()[0]))
    assert mae(scored) < 0.6 * mae(flat)
    gap = scored.agg(F.avg(F.abs(F.col("pred") - F.col("level")))).first()[0]
    assert gap < 0.5


def test_every_round_lowers_the_poisson_loss(frame):
    fitted = models.fit_boosted(frame, FEATURES, SMALL)
    losses = [fitted.raw_scores(frame, n).agg(
        F.avg(F.exp("score") - F.col("trip_count") * F.col("score"))).first()[0] for n in range(SMALL.rounds + 1)]
    assert losses == sorted(losses, reverse=True)


@pytest.mark.parametrize("q", [0.5, 0.9])
def test_quantile_boosting_covers_its_share(frame, q):
    fitted = models.fit_boosted(frame, FEATURES, replace(SMALL, loss="quantile", quantile=q))
    covered = fitted.predict(frame).agg(F.avg((F.col("trip_count") <= F.col("pred") + 0.5).cast("int"))).first()[0]
    assert covered >= q - 0.05


def test_saved_models_predict_the_same(spark, frame, tmp_path):
    fitted = models.fit_boosted(frame, FEATURES, replace(SMALL, rounds=2))
    models.save(fitted, spark, f"{tmp_path}/m")
    again = models.load(spark, f"{tmp_path}/m")
    pairs = fitted.predict(frame).select("row", "pred").join(
        again.predict(frame).select("row", F.col("pred").alias("other")), "row")
    assert pairs.where("pred <> other").count() == 0 and again.params == fitted.params


def test_params_are_checked():
    for wrong in ({"loss": "squared"}, {"max_leaf_nodes": 1}, {"quantile": 1.0}, {"max_features": 0.0}):
        with pytest.raises(ValueError):
            models.BoostParams(**wrong)


def plain_fit(x, y, p):
    """Scores of the same boosting by splitting the best leaf again and again, on all thresholds."""
    score = np.full(len(y), np.log(y.mean()) if p.loss == "poisson" else np.quantile(y, p.quantile, method="inverted_cdf"))
    for _ in range(p.rounds):
        g = np.exp(score) - y if p.loss == "poisson" else np.where(y > score, -p.quantile, 1 - p.quantile)
        h = np.exp(score) if p.loss == "poisson" else np.ones(len(y))

        def worth(rows):
            return g[rows].sum() ** 2 / max(h[rows].sum() + p.l2, 1e-12)

        def best(rows):
            top = (0.0, None, None)
            for f in range(x.shape[1]):
                for t in np.unique(x[rows, f])[:-1]:
                    low, high = rows[x[rows, f] <= t], rows[x[rows, f] > t]
                    if min(len(low), len(high)) >= p.min_samples_leaf:
                        gain = worth(low) + worth(high) - worth(rows)
                        if gain > top[0] + 1e-9:
                            top = (gain, low, high)
            return top

        leaves = [(np.arange(len(y)), best(np.arange(len(y))))]
        while len(leaves) < p.max_leaf_nodes:
            i = max(range(len(leaves)), key=lambda i: leaves[i][1][0])
            if leaves[i][1][0] <= 0:
                break
            _, (_, low, high) = leaves.pop(i)
            leaves += [(low, best(low)), (high, best(high))]
        step = np.zeros(len(y))
        for rows, _ in leaves:
            rest = y[rows] - score[rows]
            step[rows] = (-g[rows].sum() / max(h[rows].sum() + p.l2, 1e-12) if p.loss == "poisson"
                          else np.quantile(rest, p.quantile, method="inverted_cdf"))
        score = score + p.learning_rate * step
    return score


@pytest.mark.parametrize("params", [
    models.BoostParams(rounds=5, max_leaf_nodes=6, learning_rate=0.4, min_samples_leaf=4),
    models.BoostParams(rounds=2, max_leaf_nodes=9, learning_rate=0.7, min_samples_leaf=1, l2=1.5),
    models.BoostParams(loss="quantile", quantile=0.8, rounds=5, max_leaf_nodes=5, learning_rate=0.5, min_samples_leaf=7)])
def test_trees_equal_best_first_growth_by_hand(spark, params):
    rng = np.random.default_rng(1)
    x = np.stack([rng.integers(0, 9, 400), rng.integers(0, 24, 400), rng.normal(size=400).round(1)], axis=1).astype(float)
    y = rng.poisson(np.exp(0.3 * (x[:, 0] - 4) + (x[:, 1] == 8) + 0.2 * x[:, 2])).astype(float)
    df = spark.createDataFrame([(i, *r, t) for i, (r, t) in enumerate(zip(x.tolist(), y.tolist()))],
                               "row int, a double, b double, c double, trip_count double")
    fitted = models.fit_many(df, ["a", "b", "c"], [params], checkpoint_every=2)[0]
    got = {r.row: r.score for r in fitted.raw_scores(df).select("row", "score").collect()}
    assert np.allclose([got[i] for i in range(400)], plain_fit(x, y, params), atol=1e-9)


def test_candidates_grown_together_equal_their_own_fits(frame):
    grid = [SMALL, replace(SMALL, learning_rate=0.1, max_leaf_nodes=4, rounds=2), replace(SMALL, l2=2.0, max_features=0.5),
            replace(SMALL, loss="quantile", quantile=0.9, rounds=4)]
    for p, model in zip(grid, models.fit_many(frame, FEATURES, grid)):
        alone = models.fit_boosted(frame, FEATURES, p)
        assert len(model.trees) == p.rounds
        for one, two in zip(model.trees, alone.trees):
            assert (one.feature == two.feature).all() and (one.bin == two.bin).all() and np.allclose(one.value, two.value)


def test_six_hundred_trees_are_planned_at_once(frame):
    few = models.fit_boosted(frame, FEATURES, replace(SMALL, rounds=3))
    many = replace(few, trees=few.trees * 200)
    begin = time.perf_counter()
    many.predict(frame).explain("simple")
    assert time.perf_counter() - begin < 2


def test_training_rows_without_values(spark, frame):
    empty = models.fit_boosted(frame.limit(0), FEATURES, replace(SMALL, rounds=2))
    assert empty.predict(frame.limit(3)).where("pred >= 0").count() == 3
    odd = frame.withColumn("hour", F.when(F.col("row") % 3 > 0, F.col("hour")).otherwise(F.lit(float("nan"))))
    assert models.fit_boosted(odd, FEATURES, SMALL).predict(odd).where("pred is null").count() == 0


def test_quantiles_of_groups_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(int(g), float(v)) for g in range(7) for v in np.concatenate(
        [rng.normal(size=50 * g) * 10.0 ** rng.integers(-9, 9, 50 * g), rng.integers(-3, 3, 20)])]
    rows += [(None, 5.0), (None, 7.0), (8, None), (9, float("nan")), (9, 2.0), (10, float("inf"))]
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    shares = {"low": 0.0, "q3": 0.3, "mid": 0.5, "top": 0.999}
    got = {r.g: tuple(r)[1:] for r in quantiles.grouped_quantiles(df, ["g"], "v", shares).collect()}
    for g in {r[0] for r in rows}:
        own = [v for k, v in rows if k == g and v is not None and math.isfinite(v)]
        want = np.quantile(own, list(shares.values())) if own else [None] * 4
        assert got[g] == tuple(want) or np.allclose(got[g], want, rtol=1e-12)
    whole = quantiles.grouped_quantiles(df, [], "v", {"mid": 0.5}).collect()
    assert len(whole) == 1 and quantiles.grouped_quantiles(df.limit(0), ["g"], "v", shares).count() == 0


def test_bits_keep_the_order_of_doubles():
    values = np.array([-np.inf, -1e300, -2.5, -1e-300, -0.0, 0.0, 1e-300, 1.0, 2.5, np.inf])
    bits = quantiles.ordered_bits(values)
    assert (np.diff(bits.astype(object)) >= 0).all() and bits[4] == bits[5]
    assert (quantiles.unordered_bits(bits) == values).all()


def test_poisson_regression_scores_unseen_stations(frame):
    glm = models.fit_poisson_glm(frame, alpha=0.001, max_iter=25, features=["station_id", "season", "hour"])
    known = glm.predict(frame)
    by_station = {r.station_id: r.m for r in known.groupBy("station_id").agg(F.avg("pred").alias("m")).collect()}
    true = {r.station_id: r.m for r in frame.groupBy("station_id").agg(F.avg("trip_count").alias("m")).collect()}
    assert all(math.isclose(by_station[s], true[s], rel_tol=0.1) for s in true)
    strange = glm.predict(frame.limit(1).withColumn("station_id", F.lit(99))).first()
    assert strange.pred > 0 and strange.station_id == 99


def plain_regression(stations, x, y, alpha):
    """Newton steps on one dense matrix with a column per station."""
    kinds = sorted(set(stations))
    wide = np.concatenate([np.ones((len(y), 1)), np.array([[s == k for k in kinds] for s in stations], float), x], axis=1)
    ridge = np.append(0.0, np.full(wide.shape[1] - 1, alpha * len(y)))
    beta = np.zeros(wide.shape[1])
    beta[0] = np.log(y.mean())
    for _ in range(60):
        mean = np.exp(wide @ beta)
        beta += np.linalg.solve(wide.T @ (mean[:, None] * wide) + np.diag(ridge), wide.T @ (y - mean) - ridge * beta)
    return np.exp(wide @ beta)


def test_poisson_regression_solves_the_score_equations(spark):
    rng = np.random.default_rng(11)
    station = rng.integers(0, 40, 3000)
    hour = rng.integers(0, 24, 3000)
    season = rng.choice(["winter", "summer"], 3000)
    y = rng.poisson(np.exp(0.05 * station - 1 + 0.4 * (hour == 8) + 0.5 * (season == "summer"))).astype(float)
    rows = [(i, int(s), str(k), int(h), float(t)) for i, (s, k, h, t) in enumerate(zip(station, season, hour, y))]
    df = spark.createDataFrame(rows, "row int, station_id int, season string, hour int, trip_count double").repartition(3)
    fitted = models.fit_poisson_glm(df, ["station_id", "season", "hour"], alpha=0.01)
    x = np.stack([season == "summer", season == "winter", (hour - hour.mean()) / hour.std()], axis=1).astype(float)
    want = plain_regression(station.tolist(), x, y, 0.01)
    got = {r.row: r.pred for r in fitted.predict(df).select("row", "pred").collect()}
    assert np.allclose([got[i] for i in range(3000)], want, rtol=1e-7) and fitted.steps < 20


def test_poisson_regression_of_many_stations(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 10_000).cast("int").alias("station_id"), (F.col("id") % 24).cast("int").alias("hour"),
        F.pmod(F.xxhash64("id"), F.lit(7)).alias("trip_count"))
    fitted = models.fit_poisson_glm(rows, ["station_id", "hour"], alpha=1e-4)
    assert fitted.effects.count() == 10_000
    total = fitted.predict(rows).agg(F.sum("trip_count"), F.sum("pred")).first()
    assert math.isclose(total[0], total[1], rel_tol=1e-8)  # the score equation of the intercept
    empty = models.fit_poisson_glm(rows.limit(0), ["station_id", "hour"])
    assert empty.predict(rows.limit(2)).count() == 2


def test_importance_puts_the_drivers_first(frame):
    fitted = models.fit_boosted(frame, FEATURES, SMALL)
    board = models.permutation_importance(fitted, frame, ["row"], repeats=2).collect()
    assert {board[0].feature, board[1].feature} == {"station_id", "hour"}
    assert len(board) == len(FEATURES) and abs(board[-1].mae_increase) < 1e-6


def test_sweep_ranks_on_validation(frame):
    train, val = frame.where("row % 3 > 0"), frame.where("row % 3 = 0")
    board, winner = models.sweep(train, val, FEATURES, [replace(SMALL, rounds=1, learning_rate=0.01), SMALL], busy=11)
    assert winner == SMALL and board.orderBy("mae").first().model == "cand_01"


def test_ablation_has_its_baseline(frame):
    board = {r.model: r for r in models.ablation(frame, frame, SMALL).collect()}
    assert set(board) == {"baseline", "calendar", "calendar+py"} and board["baseline"].vs_baseline == 0


def test_tall_predictions_of_two_models(frame):
    fitted = {"a": models.fit_boosted(frame, FEATURES, replace(SMALL, rounds=1)),
              "b": models.fit_boosted(frame, CALENDAR_FEATURES, replace(SMALL, rounds=1))}
    scores = metrics.accuracy(models.predictions(fitted, frame, ["hour"]))
    assert sorted(r.model for r in scores.collect()) == ["a", "b"]


def test_rows_alike_are_stored_once_and_derived_features_follow(spark, frame, monkeypatch):
    """What a pass reads and adds up grows with the distinct rows and with the features that say something of their own."""
    from tidewheel.operators import trees

    written, layouts = [], []
    keep, lay = trees.materialize, trees._layout
    monkeypatch.setattr(trees, "materialize", lambda df, label="table": written.append((label, keep(df, label))) or written[-1][1])
    monkeypatch.setattr(trees, "_layout", lambda rows, sizes: layouts.append(lay(rows, sizes)) or layouts[-1])
    half = frame.withColumn("hour_sin", F.sin(F.col("hour") * F.lit(math.pi / 12)))
    once = models.fit_boosted(half, FEATURES, replace(SMALL, rounds=2))
    again = models.fit_boosted(half.unionByName(half), FEATURES, replace(SMALL, rounds=2, min_samples_leaf=10))
    binned = [df for label, df in written if label == "binned"]
    assert binned[0].count() == binned[1].count() < frame.count()
    assert [binned[i].agg(F.sum("n")).first()[0] for i in (0, 1)] == [frame.count(), 2 * frame.count()]
    names = list(trees.columns_of(FEATURES))
    assert layouts[0].follows[names.index("hour_sin")][0] == names.index("hour")
    assert names.index("month") not in layouts[0].kept() and names.index("hour") in layouts[0].kept()
    for one, two in zip(once.trees, again.trees):
        assert (one.feature == two.feature).all() and (one.bin == two.bin).all() and np.allclose(one.value, two.value)


def test_select_rank_counts_values_as_often_as_told(spark):
    values, times = np.array([3.5, -1.0, 2.0, 7.0]), np.array([2, 5, 1, 9])
    rows = spark.range(3).repartition(3)

    def pairs(batches):
        for batch in batches:
            for _ in range(batch.num_rows):
                yield np.array([0, 0, 0, 1]), quantiles.ordered_bits(values), times

    every = np.repeat(values[:3], times[:3] * 3)
    for q in (0.1, 0.6, 0.7, 0.8, 1.0):
        found = quantiles.select_rank(rows, pairs, {0: q, 1: 0.5, 2: 0.5})
        got = quantiles.unordered_bits(np.array([found[0], found[1]], np.uint64))
        assert got.tolist() == [np.quantile(every, q, method="inverted_cdf"), 7.0] and 2 not in found


def test_trees_grown_in_one_task_equal_those_grown_in_passes(frame, monkeypatch):
    """A table of few distinct rows is grown by a task per candidate, one of many by Spark jobs."""
    from tidewheel.operators import trees

    half = frame.withColumn("hour_sin", F.sin(F.col("hour") * F.lit(math.pi / 12)))
    grid = [replace(SMALL, depth=None, max_leaf_nodes=12), replace(SMALL, l2=2.0, max_features=0.5),
            replace(SMALL, loss="quantile", quantile=0.8, depth=None, max_leaf_nodes=9)]
    held = models.fit_many(half, FEATURES, grid)
    monkeypatch.setattr(trees, "HELD", 0)
    for one, two in zip(held, models.fit_many(half, FEATURES, grid, checkpoint_every=2)):
        assert len(one.trees) == len(two.trees) == SMALL.rounds
        for a, b in zip(one.trees, two.trees):
            assert (a.feature == b.feature).all() and (a.bin == b.bin).all() and (a.left == b.left).all()
            assert np.allclose(a.value, b.value) and a.depth == b.depth


def test_passes_keep_one_table_of_scores(spark, frame, monkeypatch):
    """A fit of hundreds of rounds stores its scores again and again."""
    import os

    from tidewheel.operators import trees

    kept, written = trees.materialize, []
    monkeypatch.setattr(trees, "materialize", lambda df, label="table": written.append(kept(df, label)) or written[-1])
    monkeypatch.setattr(trees, "HELD", 0)
    models.fit_boosted(frame, FEATURES, replace(SMALL, rounds=16))
    folders = [df.inputFiles() for df in written[1:] if "scores" in df.columns]
    left = [f for files in folders for f in files[:1] if os.path.exists(f.removeprefix("file:").replace("//", "/"))]
    assert len(folders) == 5 and len(left) == 2


@pytest.mark.parametrize("name", ["boosted_poisson_scores", "feature_ablation", "permutation_importance", "sweep_and_refit"])
def test_queries_fit_the_published_rounds(spark, monkeypatch, name):
    from tidewheel.contract import BOOST_DEFAULT, BOOST_GRID
    from tidewheel.queries import models as queries

    asked, fit = [], models.fit_many
    monkeypatch.setattr(models, "fit_many", lambda df, features, grid: asked.extend(grid) or fit(
        df, features, [replace(p, rounds=1, max_leaf_nodes=2) for p in grid]))
    getattr(queries, name)(spark, "/root/testdata/sf0.001")
    published = [models.BoostParams(**p) for p in (BOOST_GRID if name == "sweep_and_refit" else [BOOST_DEFAULT])]
    assert asked[:len(published)] == published and all(p.rounds >= 300 for p in asked)


def test_batch_forecasts_come_from_the_whole_shipped_model(spark, monkeypatch):
    from tidewheel.contract import BOOST_SHIPPED
    from tidewheel.queries import models as queries

    asked, fit = [], models.fit_many
    monkeypatch.setattr(models, "fit_many", lambda df, features, grid: asked.extend(grid) or fit(
        df, features, [replace(p, rounds=1, max_leaf_nodes=2) for p in grid]))
    queries.boosted_batch_forecast(spark, "/root/testdata/sf0.001")
    assert asked == [models.BoostParams("quantile", **BOOST_SHIPPED)]


def test_quantile_scores_are_those_of_whole_models(spark, monkeypatch):
    from tidewheel.contract import BOOST_SHIPPED
    from tidewheel.queries import models as queries

    asked, fit = [], models.fit_many
    monkeypatch.setattr(models, "fit_many", lambda df, features, grid: asked.extend(grid) or fit(
        df, features, [replace(p, rounds=1, max_leaf_nodes=2) for p in grid]))
    queries.boosted_quantile_scores(spark, "/root/testdata/sf0.001")
    assert asked == [models.BoostParams("quantile", **{**BOOST_SHIPPED, "quantile": q}) for q in (0.5, 0.8, 0.9)]
