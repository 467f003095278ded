"""Lookups, run records and dataset fingerprints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewheel.functions.text import composite_key

RUN_SCHEMA = "run string, split string, metric string, value double, params map<string,string>"


def to_lookup(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Aggregated `value` under a text key `a|b|c`."""
    grouped = df.groupBy(*keys).agg(value.alias("value"))
    return grouped.select(composite_key(*keys).alias("key"), "value")


def write_lookup(lookup: DataFrame, path: str) -> None:
    lookup.write.mode("overwrite").json(path)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key string, value double").json(path)


def log_run(metrics: DataFrame, path: str, run: str, params: dict[str, str]) -> None:
    """Append (split, metric, value) rows of one run to the record table."""
    pairs = [F.lit(x) for kv in params.items() for x in map(str, kv)]
    record = metrics.select(F.lit(run).alias("run"), "split", "metric", F.col("value").cast("double"),
                            F.create_map(*pairs).cast("map<string,string>").alias("params"))
    record.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def row_digest(columns: list[str]) -> Column:
    """MD5 of a row's values in a fixed text form; null is told from empty text."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]
    return F.md5(F.concat_ws("\x1f", *texts).cast("binary"))


def fingerprint(df: DataFrame, columns: list[str], by: list[str] | tuple = ()) -> DataFrame:
    """Row count and two order-free digests, so that two runs can prove equal input.

    The exclusive-or alone would let pairs of equal rows cancel out; the sum does not.
    """
    digest = row_digest(columns)
    high = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    low = F.conv(F.substring(digest, 17, 8), 16, 10).cast("decimal(20,0)")
    return df.groupBy(*by).agg(F.count("*").alias("row_count"), F.bit_xor(high).alias("xor_digest"),
                               F.sum(low).cast("string").alias("sum_digest"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
