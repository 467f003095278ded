"""Connected components of a graph given by its edges, without bringing any of it to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node it is connected with, for every node that some edge (a, b) touches.

    Large and small stars take turns until nothing moves: first every node hands its larger neighbours to its smallest
    one, then its smaller neighbours. Rounds grow with the logarithm of the size of a component. Minima are combined
    before the shuffle, and the joins back read stored tables, so a node with very many edges is split by adaptive
    execution. Edges that repeat, point both ways or have one end are allowed; rows with a null end are left out.
    """
    now = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        root = both.groupBy("a").agg(F.min("b").alias("root"))
        large = both.join(root, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "root").alias("b"))
        low = materialize(large.distinct(), "stars")
        root = low.groupBy("a").agg(F.min("b").alias("root"))
        moved = low.join(root, "a").where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
        now = materialize(root.withColumnRenamed("root", "b").unionByName(moved).distinct(), "edges")
    return now.unionByName(now.select(F.col("b").alias("a"), "b").distinct()).toDF("node", "root")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 30))).first())
