"""Bootstrap confidence interval of a paired error gap."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# draws per MD5 value: each uses eight of its 32 hex digits
_PER_DIGEST = 4
_EXACT = 5  # sums of up to 2 ** 5 counts are drawn from their cumulative probabilities, larger ones from a normal law
_UNIT = 1_000_000_000  # gaps are told apart to this fraction


def cumulative(mean: int) -> list[int]:
    """floor(2^32 * P(Poisson(mean) <= k)) for k = 0, 1, ... as far as it is below 2^32 - 1."""
    total, term, out = 0.0, math.exp(-mean), []
    while not out or out[-1] < 2 ** 32 - 1:
        total += term
        out.append(min(int(total * 2 ** 32), 2 ** 32 - 1))
        term *= mean / len(out)
        if term < 2.0 ** -40 and len(out) > mean:
            break
    return out


def _number(digest: Column, i: int) -> Column:
    return F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint")


def _draw(bit: Column, u: Column, v: Column) -> Column:
    """Poisson(2^bit) from a number, or from two numbers, of 32 bits."""
    exact = F.lit(None).cast("bigint")
    for k in range(_EXACT, -1, -1):
        exact = F.when(bit == k, F.size(F.filter(F.lit(cumulative(2 ** k)), lambda t: u >= t)).cast("bigint")).otherwise(exact)
    mean = F.pow(F.lit(2.0), bit)
    normal = F.sqrt(-2 * F.log((u + 0.5) / 2.0 ** 32)) * F.cos(2 * math.pi * v / 2.0 ** 32)
    return F.when(bit <= _EXACT, exact).otherwise(
        F.greatest(F.floor(mean + F.sqrt(mean) * normal + 0.5), F.lit(0).cast("bigint")))


def replicate_gaps(df: DataFrame, gap: str, replicates: int = 200, seed: int = 0) -> DataFrame:
    """(replicate, gap): the weighted mean gap of each bootstrap resample.

    Resampling n rows with replacement gives every row a nearly Poisson(1) count, and the n rows that have one gap a
    Poisson(n) count together. So rows are reduced to (gap, n) by a partial aggregate, and each value draws one number
    for every bit that is set in n: Poisson counts add up. Draws come from a hash of the value, the bit and the replicate,
    which makes a recomputed task repeat itself. Gaps count as equal to nine decimals; nulls are left out.
    """
    key = F.round(F.col(gap) * _UNIT).cast("bigint")
    values = df.where(F.col(gap).isNotNull()).groupBy(key.alias("k")).agg(F.count("*").alias("n"))
    blocks = math.ceil(replicates / _PER_DIGEST)
    bits = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda i: F.getbit("n", i) == 1)
    each = values.select("k", F.explode(bits).alias("bit")).select(
        "k", "bit", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    text = F.concat_ws("|", F.lit(str(seed)), "k", "bit", "block")
    drawn = each.withColumns({"h": F.md5(text.cast("binary")), "g": F.md5(F.concat(text, F.lit("|")).cast("binary"))})
    sums = []
    for i in range(_PER_DIGEST):
        w = _draw(F.col("bit"), _number(F.col("h"), i), _number(F.col("g"), i))
        sums += [F.sum(w * F.col("k") / _UNIT).alias(f"s{i}"), F.sum(w).alias(f"n{i}")]
    per_block = drawn.groupBy("block").agg(*sums)
    pairs = F.posexplode(F.array(*[F.try_divide(f"s{i}", f"n{i}") for i in range(_PER_DIGEST)])).alias("i", "gap")
    return (per_block.select("block", pairs)
            .select((F.col("block") * _PER_DIGEST + F.col("i")).alias("replicate"), "gap")
            .where(F.col("replicate") < replicates))


def paired_ci(df: DataFrame, error_a: str, error_b: str, replicates: int = 200, seed: int = 0, level: float = 0.95) -> DataFrame:
    """Mean of error_a - error_b with a percentile interval; positive means b is better."""
    gaps = df.withColumn("_gap", F.col(error_a) - F.col(error_b))
    draws = replicate_gaps(gaps, "_gap", replicates, seed)
    tail = (1 - level) / 2
    mean, base = gaps.agg(F.avg("_gap")).scalar(), gaps.agg(F.avg(error_a)).scalar()
    return draws.agg(F.percentile("gap", tail).alias("low"), F.percentile("gap", 1 - tail).alias("high"),
                     F.count("*").alias("replicates")).select(
        mean.alias("mean_gap"), "low", "high", "replicates", F.try_divide(mean, base).alias("relative_gap"))
