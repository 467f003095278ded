"""Temperature mixing of sources under a token budget.

A source with the share p of all tokens gets a weight in proportion to p ^ exponent: 1 leaves the sources as they are,
0 makes them equal. The exponent is bisected until the weights' entropy is a target, or until no source is repeated
more often than a limit. Each source then gets its weight's part of the budget, as passes over the source in an order
that is a permutation of its blocks and of the documents in each block: whole passes, and a last one that ends where
the budget does. Blocks have a bounded number of documents, so no source is ever in one task: the block in which the
last pass ends follows from the sums of blocks, and the place in it from that block alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewheel.session import materialize

BLOCK_DOCUMENTS = 4096
TOP_EXPONENT = 8
FACTOR = 32  # five halvings at once: one aggregate over the sources judges 32 exponents
ROUNDS = 6


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _search(shares: DataFrame, meets: Column) -> float:
    """The smallest exponent of the finest grid for which `meets` holds; it must hold from there on.

    `meets` may use entropy, peak (the largest weight / share) and exponent.
    """
    low, step = 0.0, TOP_EXPONENT / FACTOR
    for turn in range(ROUNDS):
        first = 0 if turn == 0 else 1
        grid = shares.where("share > 0").withColumn("i", F.explode(F.sequence(F.lit(first), F.lit(FACTOR))))
        grid = grid.withColumn("exponent", F.lit(low) + F.col("i") * F.lit(step))
        power = F.pow(F.col("share"), F.col("exponent"))
        log = F.col("exponent") * F.log("share")
        judged = grid.groupBy("i", "exponent").agg(
            (F.log(F.sum(power)) - F.sum(power * log) / F.sum(power)).alias("entropy"),
            (F.max(power / F.col("share")) / F.sum(power)).alias("peak"))
        best = judged.where(meets).agg(F.min("i")).first()[0]
        if best is None:
            best = FACTOR
        if turn == 0 and best == 0:
            return 0.0
        low, step = low + (best - 1) * step, step / FACTOR
    return low + step * FACTOR


def exponent_for(shares: DataFrame, budget_share: float, entropy_share: float | None, max_epochs: float | None) -> float:
    """The exponent at which the entropy is `entropy_share` of the largest possible, and at least the one from which
    on, up to 1, no source is repeated more than `max_epochs` times."""
    found = []
    if max_epochs is not None:
        if max_epochs < budget_share:
            raise ValueError("the budget itself takes more passes than max_epochs")
        found.append(_search(shares, (F.col("peak") * budget_share <= max_epochs) | (F.col("exponent") >= 1)))
    if entropy_share is not None:
        sources = shares.where("share > 0").count()
        found.append(_search(shares, F.col("entropy") <= entropy_share * F.log(F.lit(float(max(sources, 1))))))
    return max(found, default=1.0)


def _order_key(epoch: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"),
                          F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def _block(key: Column, blocks: Column) -> Column:
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long") % blocks


def plan(docs: DataFrame, budget_share: float, entropy_share: float | None, max_epochs: float | None,
         seed: int) -> DataFrame:
    """One row per source: what it has and gets, and where its last pass ends (cut_block, cut).

    `docs` has doc_id, source and n_tokens. A null source is a source of its own.
    """
    totals = materialize(docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents")),
                         "totals")
    everything = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    shares = totals.withColumn("share", F.col("tokens") / F.lit(float(max(everything, 1))))
    exponent = exponent_for(shares, budget_share, entropy_share, max_epochs) if everything else 1.0
    power = F.when(F.col("share") > 0, F.pow("share", F.lit(exponent))).otherwise(0.0)
    norm = shares.agg(F.sum(power)).first()[0] or 1.0
    weight = F.round(power / F.lit(norm), 9)
    target = F.floor(weight * F.lit(float(int(everything * budget_share))))
    size = F.greatest("tokens", F.lit(1))
    sources = shares.select(
        "source", "tokens", "documents", weight.alias("weight"), target.alias("target"),
        F.floor(target / size).alias("full"), (target % size).alias("rest"),
        F.ceil(F.col("documents") / BLOCK_DOCUMENTS).alias("blocks"), F.lit(exponent).alias("exponent"))
    sources = materialize(sources, "sources")
    s = sources.select(F.col("source").alias("of"), "full", "rest", "blocks")
    last = docs.join(s, F.col("source").eqNullSafe(F.col("of"))).where("rest > 0")
    last = last.withColumn("key", _order_key(F.col("full"), seed))
    last = last.select("of", "rest", _block(F.col("key"), F.col("blocks")).alias("block"), "n_tokens",
                       F.struct("key", "doc_id", "n_tokens").alias("at"))
    sums = last.groupBy("of", "rest", "block").agg(F.sum("n_tokens").alias("sum"))
    until = F.sum("sum").over(W.partitionBy("of").orderBy("block"))
    ends = sums.withColumn("until", until).where("until > rest").groupBy("of", "rest").agg(
        F.min("block").alias("cut_block"), F.min_by(F.col("until") - F.col("sum"), "block").alias("before"))
    ends = materialize(ends, "ends")
    inside = last.select("of", "block", "at", "n_tokens").join(
        ends.withColumnRenamed("of", "end_of"), F.col("of").eqNullSafe(F.col("end_of"))
        & (F.col("block") == F.col("cut_block")))
    so_far = F.sum("n_tokens").over(W.partitionBy("end_of").orderBy("at")) + F.col("before")
    kept = inside.withColumn("so_far", so_far).where("so_far <= rest").groupBy("end_of").agg(F.max("at").alias("cut"))
    cuts = ends.select("of", "cut_block").join(kept, F.col("of").eqNullSafe(F.col("end_of")), "left")
    cuts = cuts.select(F.col("of").alias("cut_of"), "cut_block", "cut")
    return materialize(sources.join(cuts, F.col("source").eqNullSafe(F.col("cut_of")), "left").drop("cut_of"), "plan")


def _in_last(key: Column, block: Column) -> Column:
    """Whether the last pass, which may be empty, has reached a document."""
    here = F.struct(key.alias("key"), F.col("doc_id"), F.col("n_tokens"))
    before = (block < F.col("cut_block")) | ((block == F.col("cut_block")) & (here <= F.col("cut")))
    return (F.col("rest") > 0) & F.coalesce(before, F.lit(False))


def passes(docs: DataFrame, sources: DataFrame, seed: int) -> Column:
    """How often a document is in the mix; for frames that hold doc_id, source, n_tokens and their source's plan."""
    key = _order_key(F.col("full"), seed)
    return F.col("full") + _in_last(key, _block(key, F.col("blocks"))).cast("long")


def mix(docs: DataFrame, budget_share: float = 1.0, entropy_share: float | None = None, max_epochs: float | None = None,
        seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix, one row for each time a document is in it: doc_id, source, n_tokens, weight, epoch, block and place.

    A source's documents follow each other by epoch, block and place. Tokens are words of the whole text. A null source
    is a source of its own, a null id orders as the text `null`; a null or empty text has no tokens and is in the mix
    whenever the passes reach it. A source without tokens gets nothing. Rows equal in id and tokens share their place
    in the order, so they are in the last pass together or not at all. Other columns are dropped.
    """
    narrow = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
                                     word_count(F.col(text_col)).alias("n_tokens")), "narrow")
    sources = plan(narrow, budget_share, entropy_share, max_epochs, seed)
    s = sources.withColumnRenamed("source", "of").drop("tokens", "documents", "target", "exponent")
    rows = narrow.join(s, F.col("source").eqNullSafe(F.col("of"))).withColumn("n", passes(narrow, sources, seed))
    rows = rows.where("n > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    rows = rows.withColumn("key", _order_key(F.col("epoch"), seed))
    rows = rows.withColumn("block", _block(F.col("key"), F.col("blocks")))
    order = W.partitionBy("of", "epoch", "block").orderBy("key", "doc_id", "n_tokens")
    return rows.select("doc_id", "source", "n_tokens", "weight", "epoch", "block",
                       F.row_number().over(order).alias("place"))


def mixed(docs: DataFrame, budget_share: float = 1.0, entropy_share: float | None = None,
          max_epochs: float | None = None, seed: int = 0) -> DataFrame:
    """`docs` with every document as often as it is in the mix, with all its columns; see `mix`."""
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    counted = packed.select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.source").alias("source"),
                            word_count(F.col("row.text")).alias("n_tokens"), "row")
    narrow = materialize(counted.drop("row"), "narrow")
    sources = plan(narrow, budget_share, entropy_share, max_epochs, seed)
    s = sources.withColumnRenamed("source", "of").drop("tokens", "documents", "target", "exponent", "weight")
    rows = counted.join(s, F.col("source").eqNullSafe(F.col("of"))).withColumn("n", passes(narrow, sources, seed))
    return rows.where("n > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select("row.*")
