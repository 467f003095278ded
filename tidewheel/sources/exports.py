"""Exports with a manifest, and row-count reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.contract import STAR_PARTITIONS
from tidewheel.sources.tables import write_partitioned, write_small


def manifest(tables: dict[str, DataFrame], partitions: dict[str, list[str]] = STAR_PARTITIONS) -> DataFrame:
    """Rows, columns and partition columns per table."""
    rows = [df.agg(F.lit(name).alias("table_name"),
                   F.count("*").alias("row_count"),
                   F.lit(len(df.columns)).alias("column_count"),
                   F.lit(",".join(partitions.get(name, []))).alias("partitioned_by"))
            for name, df in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def export_tables(tables: dict[str, DataFrame], path: str,
                  partitions: dict[str, list[str]] = STAR_PARTITIONS) -> DataFrame:
    """Write every table below `path`, keep its partitioning, record a manifest."""
    for name, df in tables.items():
        if partitions.get(name):
            write_partitioned(df, f"{path}/{name}", partitions[name])
        else:
            write_small(df, f"{path}/{name}")
    spark = next(iter(tables.values())).sparkSession
    # the manifest counts the source tables, so it can prove the files it describes
    (manifest(tables, partitions)
     .withColumns({"exported_at": F.current_timestamp(), "spark_version": F.lit(spark.version)})
     .coalesce(1).write.mode("overwrite").json(f"{path}/manifest"))
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "table_name string, row_count bigint, column_count int, partitioned_by string, "
        "exported_at timestamp, spark_version string").json(f"{path}/manifest")


def read_export(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}


def reconcile(tables: dict[str, DataFrame], recorded: DataFrame) -> DataFrame:
    """Recorded against present row counts, one row per table."""
    counts = reduce(DataFrame.unionByName, [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("found_rows"))
        for name, df in tables.items()])
    return (recorded.join(counts, "table_name", "left")
            .withColumn("status", F.when(F.col("found_rows") == F.col("row_count"), "ok").otherwise("FAIL")))


def reconcile_groups(written: DataFrame, read: DataFrame, keys: list[str], measures: dict) -> DataFrame:
    """Compare aggregated `measures` of two frames per key group."""
    left = written.groupBy(*keys).agg(*[m.alias(f"written_{n}") for n, m in measures.items()])
    right = read.groupBy(*keys).agg(*[m.alias(f"read_{n}") for n, m in measures.items()])
    same = reduce(lambda a, b: a & b,
                  [F.col(f"written_{n}").eqNullSafe(F.col(f"read_{n}")) for n in measures])
    return left.join(right, keys, "full_outer").withColumn("status", F.when(same, "ok").otherwise("FAIL"))
