"""Dense surrogate keys without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidewheel.session import materialize

# monotonically_increasing_id() holds the partition number above bit 33.
_SHIFT = 33


def with_dense_id(df: DataFrame, order_by: list[str], name: str, partitions: int | None = None) -> DataFrame:
    """Add `name` = 1..n in the order of `order_by`, computed in parallel.

    Rows are range-partitioned on the ordering columns and then on all other columns,
    so one hot ordering value is cut by its other values and the numbering of a reload
    is the same. Copies equal in every column are cut by a position that is written
    with the rows first: it cannot change when a task is repeated, and the sampling for
    the ranges reads that table instead of running the input twice. The placed rows are
    written too; the sizes of the written ranges give each range its first number.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*order_by, *[c for c in df.columns if c not in order_by], "_copy"]
    copies = materialize(df.withColumn("_copy", F.monotonically_increasing_id()), "unnumbered")
    placed = materialize(
        copies.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_copy")
        .withColumn("_place", F.monotonically_increasing_id()), "numbered")

    ranged = placed.withColumn("_range", F.shiftright("_place", _SHIFT))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    # one row per range: at most `n` rows reach this window and the broadcast below
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    position = F.col("_place") - F.shiftleft("_range", _SHIFT)
    return (ranged.join(F.broadcast(starts), "_range")
            .select((F.col("_start") + position + 1).cast("bigint").alias(name), *df.columns))
