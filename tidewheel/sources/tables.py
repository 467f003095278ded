"""Parquet tables: creation, partition overwrite, replacement, description."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewheel.contract import STAR_COLUMNS, STAR_PARTITIONS, star_schema
from tidewheel.session import remove_folder, scratch_path


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str,
                 partitions: list[str] | tuple = ()) -> None:
    """Register an external Parquet table from a schema, replacing an older entry.

    The schema is declared and not read from files, so an empty table works too.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by} LOCATION '{location}'")


_VERSION = "tidewheel.table"  # the property of a view that names the table behind it


def create_versioned(spark: SparkSession, name: str, schema: T.StructType, location: str,
                     partitions: list[str] | tuple = ()) -> None:
    """Register a table that `swap_table` can replace: a view over its present version, which is an external table."""
    if spark.catalog.tableExists(name):
        kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} {name}")
    version = _new_version(name)
    create_table(spark, version, schema, location, partitions)
    _point(spark, name, version)
    _drop_others(spark, name)


def _new_version(name: str) -> str:
    return f"{name}__{uuid.uuid4().hex}"


def _point(spark: SparkSession, name: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_VERSION}' = '{version}') AS SELECT * FROM {version}")


def version_of(spark: SparkSession, name: str) -> str:
    """The table behind a versioned one; the name itself for any other."""
    if spark.catalog.getTable(name).tableType != "VIEW":
        return name
    return spark.sql(f"SHOW TBLPROPERTIES {name} ('{_VERSION}')").first()["value"]


def _location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]


def _drop_others(spark: SparkSession, name: str, folders: bool = False) -> None:
    """Drop the versions that the view does not point to, with `folders` their files too."""
    present = version_of(spark, name)
    for row in spark.sql(f"SHOW TABLES LIKE '{name}__*'").collect():
        if row.tableName != present:
            folder = _location(spark, row.tableName)
            spark.sql(f"DROP TABLE {row.tableName}")
            if folders:
                remove_folder(spark, folder)


def register_partitions(spark: SparkSession, name: str) -> None:
    """Make directories written below a table visible to the catalog."""
    spark.sql(f"MSCK REPAIR TABLE {version_of(spark, name)}")


def create_star(spark: SparkSession, location: str, prefix: str = "") -> list[str]:
    """Create the five empty star tables; the obsolete time dimension goes away."""
    spark.sql(f"DROP TABLE IF EXISTS {prefix}dim_time")
    for table in STAR_COLUMNS:
        create_table(spark, prefix + table, star_schema(table), f"{location}/{table}",
                     STAR_PARTITIONS.get(table, ()))
    return [prefix + table for table in STAR_COLUMNS]


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite",
                      dynamic: bool = False, gather: bool = True) -> None:
    """Hive-style partitioned Parquet.

    With `dynamic`, only partitions that occur in `df` are replaced. With `gather`, rows
    are brought together per partition value first, in pieces that AQE sizes and splits,
    so that many values make neither one file per task and value nor one task per hot
    value. A handful of values needs no such exchange.
    """
    rows = df.hint("rebalance", *map(F.col, by)) if gather else df
    (rows.write.mode(mode).partitionBy(*by)
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(path))


def replace_partition(df: DataFrame, path: str, **keys: str) -> None:
    """Replace exactly one partition, also when no row is left for it."""
    folder = "/".join(f"{k}={v}" for k, v in keys.items())
    df.drop(*keys).write.mode("overwrite").parquet(f"{path}/{folder}")


def write_small(df: DataFrame, path: str) -> None:
    """A dimension as few, sorted-by-key files of the size AQE finds right."""
    df.hint("rebalance").write.mode("overwrite").parquet(path)


def swap_table(df: DataFrame, name: str, partitions: list[str] | tuple = (), root: str | None = None) -> str:
    """Replace a versioned table by a frame that may read the same table.

    The rows become a new version in a fresh folder, with all its partitions. Then one statement points the view there, so
    that readers see the old table or the new one and nothing in between, wherever the job stops. Versions that nothing
    points to are dropped last, with their files. Returns the new location.
    """
    spark = df.sparkSession
    if version_of(spark, name) == name:
        raise ValueError(f"{name} is no versioned table")
    fresh = f"{root}-{uuid.uuid4().hex}" if root else scratch_path(spark, name)
    version = _new_version(name)
    if partitions:
        write_partitioned(df, fresh, list(partitions))
    else:
        write_small(df, fresh)
    create_table(spark, version, df.select(*[c for c in df.columns if c not in partitions], *partitions).schema, fresh,
                 partitions)
    if partitions:
        register_partitions(spark, version)
    _point(spark, name, version)
    _drop_others(spark, name, folders=True)
    return fresh


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def schema_table(df: DataFrame) -> DataFrame:
    """Position, name and type of every column."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, column_type string")


def describe_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    """`schema_table` of several catalog tables, with the table name in front."""
    frames = [schema_table(spark.table(n)).select(F.lit(n).alias("table_name"), "*") for n in names]
    return reduce(DataFrame.unionByName, frames)
