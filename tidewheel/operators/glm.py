"""Penalised Poisson regression with any number of stations, by Newton steps.

The Hessian has the shape of an arrow: station effects touch each other nowhere, only the few other coefficients. So a step
sums up the rows per station first, eliminates the stations by their own sums (the Schur complement), solves a dense
system for the few, and each station's step follows from that. Stations stay distributed; the driver sees sums over all
of them whose size depends on the number of other coefficients alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.contract import CALENDAR_FEATURES, CATEGORICAL_FEATURES, TARGET
from tidewheel.functions.encoding import clipped
from tidewheel.session import materialize

ABSORBED = "station_id"  # the category that may have any number of values
FLUSH = 50_000  # stations of which a task holds sums at a time
_LARGEST = 500.0  # exponents beyond this are cut


@dataclass
class PoissonRegression:
    intercept: float
    levels: dict[str, list[str]]  # of the other categories, one coefficient each
    numbers: list[str]
    centre: list[float]
    scale: list[float]
    weights: list[float]
    effects: DataFrame  # station, effect
    steps: int

    def inputs(self) -> list[Column]:
        """The columns that `weights` belong to."""
        return _inputs(self.levels, self.numbers, self.centre, self.scale)

    def predict(self, df: DataFrame) -> DataFrame:
        """All columns of `df` and `pred`; categories that the fit has not seen have no effect."""
        known = self.effects.select(F.col("station").alias("_station"), F.col("effect").alias("_effect"))
        joined = df.join(known, _station(df) == F.col("_station"), "left")
        terms = [F.lit(self.intercept), F.coalesce("_effect", F.lit(0.0))]
        terms += [F.lit(w) * x for w, x in zip(self.weights, self.inputs())]
        total = terms[0]
        for term in terms[1:]:
            total = total + term
        return joined.select(*df.columns, clipped(F.exp(F.least(total, F.lit(_LARGEST)))).alias("pred"))


def _station(df: DataFrame) -> Column:
    return F.coalesce(F.col(ABSORBED).cast("string"), F.lit("")) if ABSORBED in df.columns else F.lit("")


def _inputs(levels: dict[str, list[str]], numbers: list[str], centre: list[float], scale: list[float]) -> list[Column]:
    out = [F.col(c).eqNullSafe(v).cast("double") for c, values in levels.items() for v in values]
    return out + [(F.coalesce(F.col(n).cast("double"), F.lit(m)) - F.lit(m)) / F.lit(s)
                  for n, m, s in zip(numbers, centre, scale)]


def _added(parts: DataFrame, column: str, size: int) -> np.ndarray:
    """The sum of packed rows of doubles: by partition first, then of one row per partition."""
    def add(batches):
        total = np.zeros(size)
        for batch in batches:
            for packed in batch.column(column).to_pylist():
                total += np.frombuffer(packed)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], [column])

    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = parts.select(column).repartition(n).mapInArrow(add, f"{column} binary").collect()
    return sum((np.frombuffer(r[column]) for r in rows), np.zeros(size))


def _sums(rows: DataFrame, effects: DataFrame, beta: np.ndarray) -> DataFrame:
    """Partial sums at the present coefficients: per station, and for the others as one packed row a task."""
    p = len(beta)

    def partial(batches):
        found: dict[str, np.ndarray] = {}
        dense = np.zeros(1 + p + p * p)

        def listed(whole: bool):
            packed = [dense.tobytes()] if whole else []
            columns = np.array(list(found.values())).reshape(len(found), p + 2)
            return pa.RecordBatch.from_arrays(
                [pa.array([*found, *[None] * len(packed)], pa.string()),
                 *[pa.array(np.append(columns[:, i], [0.0] * len(packed))) for i in range(p + 2)],
                 pa.array([None] * len(found) + packed, pa.binary())], names)

        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
            y = batch.column("y").to_numpy()
            line = x @ beta + batch.column("effect").to_numpy()
            mean = np.exp(np.minimum(line, _LARGEST))
            rest = y - mean
            dense += np.concatenate([[(mean - y * line).sum()], x.T @ rest, (x.T @ (mean[:, None] * x)).ravel()])
            codes = batch.column("station").dictionary_encode()
            index, kinds = codes.indices.to_numpy(), codes.dictionary.to_pylist()
            own = np.stack([np.bincount(index, w, len(kinds)) for w in (mean, rest, *(mean * c for c in x.T))], axis=1)
            for kind, sums in zip(kinds, own):
                found[kind] = found[kind] + sums if kind in found else sums
            if len(found) > FLUSH:
                yield listed(False)
                found.clear()
        yield listed(True)

    names = ["station", *[f"s{i}" for i in range(p + 2)], "dense"]
    schema = "station string, " + ", ".join(f"s{i} double" for i in range(p + 2)) + ", dense binary"
    return materialize(rows.join(effects, "station").mapInArrow(partial, schema), "sums")


def fit_poisson_glm(train: DataFrame, features: list[str] = CALENDAR_FEATURES, alpha: float = 1.0, max_iter: int = 300,
                    tolerance: float = 1e-9) -> PoissonRegression:
    """One-hot categories, scaled numbers, log link; half the mean deviance plus alpha / 2 times the squared coefficients.

    The intercept is not penalised. Steps end when none of the coefficients moves by more than `tolerance`, or after
    `max_iter`; a step that raises the objective is halved. Nulls in numbers count as the mean. Without rows all is zero.
    """
    levels = {c: [r[0] for r in train.select(F.col(c).cast("string")).where(F.col(c).isNotNull()).distinct().orderBy(c).collect()]
              for c in CATEGORICAL_FEATURES if c in features and c != ABSORBED}
    numbers = [f for f in features if f not in CATEGORICAL_FEATURES]
    stats = train.agg(F.count("*").alias("rows"), F.avg(TARGET).alias("y"), *[f(F.col(c).cast("double")).alias(f"{k}_{c}")
                      for c in numbers for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    centre = [stats[f"m_{c}"] or 0.0 for c in numbers]
    scale = [stats[f"s_{c}"] or 1.0 for c in numbers]
    station = _station(train) if ABSORBED in features else F.lit("")
    x = F.array(*_inputs(levels, numbers, centre, scale)).cast("array<double>")
    rows = materialize(train.select(station.alias("station"), x.alias("x"), F.col(TARGET).cast("double").alias("y")), "glm")
    beta = np.zeros(1 + sum(map(len, levels.values())) + len(numbers))
    zero = F.lit(0.0)
    effects = materialize(rows.select("station").distinct().withColumn("effect", zero), "effects")
    if not stats["rows"]:
        return PoissonRegression(0.0, levels, numbers, centre, scale, beta[1:].tolist(), effects, 0)
    beta[0] = np.log(max(stats["y"], 1e-9))
    p, weight = len(beta), alpha * stats["rows"]
    ridge = np.append(0.0, np.full(p - 1, weight))
    best, before, length, steps = np.inf, None, 1.0, 0
    for steps in range(1, max_iter + 1):
        sums = _sums(rows, effects, beta)
        dense = _added(sums.where("dense is not null"), "dense", 1 + p + p * p)
        own = sums.where("station is not null").groupBy("station").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(p + 2)])
        own = materialize(own.join(effects, "station"), "own")
        squares = own.agg(F.sum(F.col("effect") * F.col("effect"))).first()[0]
        objective = dense[0] + weight / 2 * (squares + (beta[1:] ** 2).sum())
        if objective > best + 1e-9 * abs(best) and length > 1e-6:  # too far: half of the last step
            length /= 2
            beta = before["beta"] + length * before["step"]
            effects = materialize(before["effects"].select("station", (F.col("effect") + length * F.col("move")).alias("effect")), "effects")
            continue
        best = objective
        hessian, slope = dense[1 + p:].reshape(p, p) + np.diag(ridge), dense[1:1 + p] - ridge * beta
        bound = F.col("s0") + F.lit(weight)
        pull = F.col("s1") - F.lit(weight) * F.col("effect")
        cross = [F.col(f"s{i + 2}") for i in range(p)]
        if ABSORBED in features:
            def schur(batches):
                total = np.zeros(p + p * p)
                for batch in batches:
                    d, g = (batch.column(c).to_numpy() for c in ("bound", "pull"))
                    c = np.stack([batch.column(f"s{i + 2}").to_numpy() for i in range(p)], axis=1)
                    fine = d > 0
                    part = c[fine] / d[fine, None]
                    total += np.concatenate([part.T @ g[fine], (part.T @ c[fine]).ravel()])
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

            ready = own.select(bound.alias("bound"), pull.alias("pull"), *cross)
            part = _added(ready.mapInArrow(schur, "part binary"), "part", p + p * p)
            slope, hessian = slope - part[:p], hessian - part[p:].reshape(p, p)
        step = np.linalg.lstsq(hessian, slope, rcond=1e-12)[0]
        move = pull
        for i in range(p):
            move = move - cross[i] * F.lit(float(step[i]))
        move = F.coalesce(F.try_divide(move, bound), zero) if ABSORBED in features else zero
        before = {"beta": beta, "step": step, "effects": materialize(
            own.select("station", "effect", move.alias("move")), "moves")}
        length, beta = 1.0, beta + step
        effects = materialize(before["effects"].select("station", (F.col("effect") + F.col("move")).alias("effect")), "effects")
        if max(np.abs(step).max(), before["effects"].agg(F.max(F.abs("move"))).first()[0]) < tolerance:
            break
    return PoissonRegression(float(beta[0]), levels, numbers, centre, scale, beta[1:].tolist(), effects, steps)
