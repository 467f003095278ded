"""Exact quantiles of many groups by distributed selection.

A pass counts the values of every group by their leading bits, the ranges that hold the wanted ranks are kept, and the
next pass counts those by further bits. What is exchanged and kept are counts; no task and no driver holds a group, and no
sketch decides a value. Doubles are compared by bit patterns that sort as they do.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewheel.session import materialize

BITS = 16  # a pass tells 2^BITS ranges of a group apart

_U = np.uint64
_TOP = _U(1 << 63)


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles; both zeros are one."""
    bits = (np.asarray(values, np.float64) + 0.0).view(_U)
    return np.where(bits & _TOP, ~bits, bits | _TOP)


def unordered_bits(bits: np.ndarray) -> np.ndarray:
    return np.where(bits & _TOP, bits & ~_TOP, ~bits).view(np.float64)


def select_rank(rows: DataFrame, values: Callable[[Iterator], Iterator], levels: dict[int, float]) -> dict[int, int]:
    """Per group the least value at or below which at least the group's share `levels` of its values lie, as bits.

    `values` turns a task's Arrow batches into arrays (group, ordered bits), or these and how often each counts. The groups
    are few enough to be listed, as the leaves of a tree; each may hold any number of rows. Groups without values are left
    out. A range is known by the least and greatest value in it, so that one of a single value is done.
    """
    sc = rows.sparkSession.sparkContext
    low, high = dict.fromkeys(levels, 0), dict.fromkeys(levels, (1 << 64) - 1)
    rank: dict[int, int] = {}
    open_groups, answer = set(levels), {}
    while open_groups:
        shift = {g: max(0, (high[g] - low[g]).bit_length() - BITS) for g in open_groups}
        told = sc.broadcast({g: (low[g], high[g], shift[g]) for g in open_groups})

        def count(batches):
            groups = np.array(sorted(told.value))
            bounds = np.array([told.value[g] for g in groups.tolist()], _U).reshape(-1, 3)
            met: list[tuple] = []

            def gathered(met):
                at, part, n, least, most = (np.concatenate(c) for c in zip(*met))
                order = np.lexsort((part, at))
                at, part = at[order], part[order]
                first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (part[1:] != part[:-1])]))
                return (at[first], part[first], np.add.reduceat(n[order], first), np.minimum.reduceat(least[order], first),
                        np.maximum.reduceat(most[order], first))

            for group, bits, *more in values(batches):
                at = np.minimum(np.searchsorted(groups, group), len(groups) - 1)
                own = bounds[at]
                inside = (groups[at] == group) & (bits >= own[:, 0]) & (bits <= own[:, 1])
                if inside.any():
                    at, bits, own = at[inside], bits[inside], own[inside]
                    n = more[0][inside] if more else np.ones(len(at), np.int64)
                    met.append(gathered([(at, (bits - own[:, 0]) >> own[:, 2], n, bits, bits)]))
                    if sum(len(m[0]) for m in met[1:]) > len(met[0][0]) + (1 << 17):
                        met = [gathered(met)]
            if met:
                at, part, n, least, most = gathered(met)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(groups[at]), pa.array(part.astype(np.int64)), pa.array(n.astype(np.int64)),
                     pa.array((least ^ _TOP).view(np.int64)), pa.array((most ^ _TOP).view(np.int64))],
                    ["g", "part", "n", "low", "high"])

        counted = rows.mapInArrow(count, "g long, part long, n long, low long, high long").groupBy("g", "part").agg(
            F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        # 2^BITS ranges may be many for the driver, but a window over the ranges of a group needs only their counts
        upto = counted.withColumn("upto", F.sum("n").over(W.partitionBy("g").orderBy("part")))
        total = upto.withColumn("total", F.sum("n").over(W.partitionBy("g")))
        spec = F.create_map(*[F.lit(x) for g in sorted(open_groups) for x in (g, rank.get(g, -1))])
        share = F.create_map(*[F.lit(x) for g in sorted(open_groups) for x in (g, float(levels[g]))])
        wanted = F.when(spec[F.col("g")] >= 0, spec[F.col("g")]).otherwise(
            F.greatest(F.ceil(share[F.col("g")] * F.col("total") - 1e-9), F.lit(1)))
        hit = total.where((F.col("upto") >= wanted) & (F.col("upto") - F.col("n") < wanted)).select(
            "g", "low", "high", (wanted - F.col("upto") + F.col("n")).alias("rank"))
        met = {r["g"]: r for r in hit.collect()}
        for g in list(open_groups):
            r = met.get(g)
            if r is None:  # an empty group
                open_groups.discard(g)
                continue
            low[g], high[g], rank[g] = r["low"] + (1 << 63), r["high"] + (1 << 63), r["rank"]
            if low[g] == high[g]:
                answer[g] = low[g]
                open_groups.discard(g)
        told.destroy()
    return answer


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """keys and one column per share: the interpolated quantile of a numeric column, for any number of groups.

    Values that are null or not finite are left out; a group of none has nulls. Groups stay distributed: each pass
    joins the rows to the ranges of their group that are still open, counts them, and picks the range of every rank.
    Without keys there is one row.
    """
    names = [f"k{i}" for i in range(len(keys) + 1)]
    same = [F.col(k).alias(n) for k, n in zip(keys, names)]
    plain = df.select(*same, F.lit(0).alias(names[-1]), F.col(value).cast("double").alias("v"))
    rows = materialize(plain.where(F.col("v").isNotNull() & (F.abs("v") < float("inf"))), "values")
    sizes = rows.groupBy(*names).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    exact = F.explode(F.array(*[F.struct(F.lit(s).alias("share"), F.lit(up).alias("up")) for s in shares for up in (0, 1)]))
    share = F.create_map(*[F.lit(x) for s, q in shares.items() for x in (s, float(q))])
    place = share[F.col("share")] * (F.col("n") - 1)
    asked = sizes.withColumn("w", exact).select(*names, "n", "low", "high", "w.*").withColumn(
        "rank", F.when(F.col("up") == 0, F.floor(place)).otherwise(F.ceil(place)).cast("long") + 1)
    ranges = asked.groupBy(*names, "low", "high", "rank").agg(F.lit(1).alias("_")).drop("_")
    ranges = materialize(ranges.withColumn("goal", F.col("rank")), "ranges")
    done = []
    same_group = [F.col(f"r.{n}").eqNullSafe(F.col(f"v.{n}")) for n in names]
    while True:
        found = ranges.where("low = high").select(*names, "goal", F.col("low").alias("value"))
        done.append(found)
        left = ranges.where("low < high")
        if left.isEmpty():
            break
        step = F.lit(1 << 10)
        span = F.col("high") - F.col("low")
        bucket = F.least(F.floor((F.col("v") - F.col("low")) / span * step), step - 1)
        inside = rows.alias("v").join(left.alias("r"), same_group + [F.col("v.v").between(F.col("r.low"), F.col("r.high"))])
        counts = inside.select(*[F.col(f"r.{n}").alias(n) for n in names], "low", "high", "rank", "goal", "v").groupBy(
            *names, "goal", "rank", bucket.alias("bucket")).agg(
            F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        upto = F.sum("n").over(W.partitionBy(*names, "goal").orderBy("bucket"))
        ranges = materialize(counts.withColumn("upto", upto).where("upto >= rank and upto - n < rank").select(
            *names, "goal", "low", "high", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank")), "ranges")
    values = done[0]
    for more in done[1:]:
        values = values.unionByName(more)
    values = materialize(values.select(*[F.col(n).alias(f"x{n}") for n in names], F.col("goal"), "value"), "quantiles")
    match = [F.col(n).eqNullSafe(F.col(f"x{n}")) for n in names] + [F.col("rank") == F.col("goal")]
    picked = asked.join(values, match).groupBy(*names, "share").agg(
        F.max(F.when(F.col("up") == 0, F.col("value"))).alias("a"), F.max(F.when(F.col("up") == 1, F.col("value"))).alias("b"),
        F.max("n").alias("n"))
    part = share[F.col("share")] * (F.col("n") - 1)
    at = F.col("a") + (F.col("b") - F.col("a")) * (part - F.floor(part))
    wide = picked.groupBy(*names).agg(*[F.max(F.when(F.col("share") == s, at)).alias(s) for s in shares])
    groups = plain.select(*names).distinct() if keys else df.sparkSession.range(1).select(F.lit(0).alias(names[-1]))
    wide = wide.toDF(*[f"x{n}" for n in names], *shares)
    out = groups.join(wide, [F.col(n).eqNullSafe(F.col(f"x{n}")) for n in names], "left")
    return out.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], *shares)
