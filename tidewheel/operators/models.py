"""Demand models: Poisson regression and boosted trees, and what is asked of them."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewheel.contract import BUSY_THRESHOLD, CALENDAR_FEATURES, PRIOR_FEATURES, TARGET
from tidewheel.operators.baseline import fit_cells, predict_cells, tall_predictions
from tidewheel.operators.glm import PoissonRegression, fit_poisson_glm  # noqa: F401
from tidewheel.operators.metrics import accuracy, compare, leaderboard
from tidewheel.operators.trees import (BoostedTrees, BoostParams, columns_of, fit_many, inputs, load, save,  # noqa: F401
                                       to_bins)
from tidewheel.session import materialize


# --- Boosted trees ---------------------------------------------------------

def fit_boosted(train: DataFrame, features: list[str], params: BoostParams = BoostParams()) -> BoostedTrees:
    """Gradient boosting with Poisson or quantile loss; see `trees`."""
    return fit_many(train, features, [params])[0]


def predictions(models: dict[str, object], df: DataFrame, keep: list[str]) -> DataFrame:
    """Tall (keep.., y, model, pred) of several fitted models."""
    frames = [m.predict(df).select(*keep, F.col(TARGET).cast("double").alias("y"), F.lit(name).alias("model"), "pred")
              for name, m in models.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def sweep(train: DataFrame, val: DataFrame, features: list[str], grid: list[BoostParams],
          busy: int) -> tuple[DataFrame, BoostParams]:
    """Fit all candidates in the same passes and rank them on validation only; the test split is not used.

    Returns the leaderboard and the winning parameters; refit those for the final model.
    """
    names = {f"cand_{i:02d}": p for i, p in enumerate(grid)}
    fitted = dict(zip(names, fit_many(train, features, grid)))
    scores = accuracy(predictions(fitted, val, ["hour"]), busy=busy)
    ranked = materialize(leaderboard(scores), "leaderboard")
    winner = ranked.orderBy("mae", "model").first()["model"]
    return ranked, replace(names[winner])


def ablation(train: DataFrame, val: DataFrame, params: BoostParams, sets: dict[str, list[str]] | None = None,
             busy: int = BUSY_THRESHOLD) -> DataFrame:
    """Accuracy on validation of the cell means and of the same learner with each feature set, against the cell means.

    By default the sets are the calendar features, without and with the prior-year ones.
    """
    sets = sets or {"calendar": CALENDAR_FEATURES, "calendar+py": CALENDAR_FEATURES + PRIOR_FEATURES}
    cells = fit_cells(train, {"baseline": F.avg(TARGET)})
    tall = tall_predictions(predict_cells(val, cells, ["baseline"]), ["baseline"], ["hour"])
    fitted = {name: fit_boosted(train, features, params) for name, features in sets.items()}
    return compare(accuracy(tall.unionByName(predictions(fitted, val, ["hour"])), busy=busy), "baseline")


BLOCK_ROWS = 65_536  # rows among which a feature is shuffled


def permutation_importance(model: BoostedTrees, df: DataFrame, key: list[str], repeats: int = 3,
                           seed: int = 0) -> DataFrame:
    """Rise of the MAE over all rows when one feature is shuffled.

    Rows are dealt by a digest of `key` into blocks and put in its order, which is a random one. In repeat r a row takes the
    feature from the r-th row after it, around the end of the block. A block is scored once; for each feature only the trees
    that look at it are scored again, in place, so no row is copied. Rows with one key are in any order.
    """
    names = list(columns_of(model.features))
    groups = [[i for i, n in enumerate(names) if n == f or (f == "season" and n.startswith("season_"))] for f in model.features]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    rows = df.select(inputs(model.features).alias("inputs"), F.col(TARGET).cast("double").alias("y"), digest.alias("place"))
    rows = materialize(rows, "rows")
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    dealt = rows.withColumn("block", F.pmod(F.conv(F.substring("place", 1, 8), 16, 10).cast("long"), F.lit(blocks)))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def errors(block: pa.Table) -> pa.Table:
        model = shared.value
        block = block.sort_by("place")
        values = block.column("inputs").combine_chunks()
        y = block.column("y").to_numpy()
        bins = to_bins(values.flatten().to_numpy().reshape(len(y), -1), model.edges)
        each = [t.value[t.leaves(bins)] for t in model.trees]
        score, uses = model.start + np.sum(each, axis=0, initial=0.0), model.uses()
        out = [("", 0, np.abs(y - model.to_level(score)).sum(), len(y))]
        for name, columns in zip(model.features, groups):
            touched = [i for i, u in enumerate(uses) if u & set(columns)]
            for repeat in range(1, repeats + 1):
                moved = bins.copy()
                moved[:, columns] = np.roll(bins[:, columns], -repeat, axis=0)
                other = score + sum((t.value[t.leaves(moved)] - each[i] for i in touched for t in (model.trees[i],)), 0.0)
                out.append((name, repeat, np.abs(y - model.to_level(other)).sum(), len(y)))
        return pa.table({n: pa.array(c) for n, c in zip(("feature", "repeat", "error", "n"), zip(*out))})

    summed = dealt.groupBy("block").applyInArrow(errors, "feature string, repeat long, error double, n long")
    total = materialize(summed.groupBy("feature", "repeat").agg((F.sum("error") / F.sum("n")).alias("mae")), "errors")
    base = total.where("repeat = 0").agg(F.avg("mae")).first()[0]
    return total.where("repeat > 0").groupBy("feature").agg((F.avg("mae") - F.lit(base)).alias("mae_increase")).orderBy(
        F.desc("mae_increase"), "feature")
