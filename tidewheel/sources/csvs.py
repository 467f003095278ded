"""Raw yearly CSV files -> the all-string stage layout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.contract import OPTIONAL_COLUMNS, RAW_HEADERS, STAGE_COLUMNS


_FILLED = r"[^\x00-\x20]"  # what makes a line count
_AROUND = "﻿ \t\r"  # what may stand around a header: byte order mark, blanks, the end of a CRLF line


def header_names(headers: list[str], wanted: dict[str, str] = RAW_HEADERS, where: str = "csv header") -> dict[str, str]:
    """Map headers as they stand in the file to stage names; fail when one is absent."""
    names = {h: wanted[h.strip(_AROUND)] for h in headers if h.strip(_AROUND) in wanted}
    absent = sorted(set(wanted.values()).difference(names.values()))
    if absent:
        raise ValueError(f"{where} lacks {absent}")
    return names


def align(df: DataFrame, columns: list[str] = STAGE_COLUMNS,
          optional: list[str] = OPTIONAL_COLUMNS) -> DataFrame:
    """The given columns in the given order; absent optional ones are null."""
    filled = {c: F.lit(None).cast("string") for c in optional if c not in df.columns}
    return df.withColumns(filled).select(*columns)


def _lines(spark: SparkSession, path) -> DataFrame:
    """Lines that are not blank, with their file. Carriage returns stay: only a line feed ends a line."""
    lines = spark.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_path").alias("file"))
    return lines.where(F.col("value").rlike(_FILLED))


def file_headers(spark: SparkSession, path) -> dict[str, list[str]]:
    """The header lines below `path`, each with its files: the first line of a file that is not blank.

    Only lines of a file's first block are looked at, and of those only whether they are blank and where they stand.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    begun = lines.where((F.col("block") == 0) & F.col("value").rlike(_FILLED)).withColumn(
        "place", F.monotonically_increasing_id())  # ascends within a block
    per_file = begun.groupBy("file").agg(F.min(F.struct("place", "value")).alias("first"))
    found = per_file.groupBy(F.col("first.value").alias("header")).agg(
        F.sort_array(F.collect_list("file")).alias("files")).orderBy("files")
    return {row.header: row.files for row in found.collect()}


def read_raw_csv(spark: SparkSession, path: str, wanted: dict[str, str] = RAW_HEADERS) -> DataFrame:
    """All files below `path` (a glob or a list) as strings, in stage order.

    Files are read by groups of one header line, so that each is bound by its own headers; a file that lacks one is
    named in the error. Spark leaves out blank lines.
    """
    parts = []
    for files in file_headers(spark, path).values():
        raw = spark.read.csv(files, header=True, inferSchema=False, multiLine=False, encoding="UTF-8", lineSep="\n")
        names = header_names(raw.columns, wanted, files[0])
        last = raw.columns[-1]  # carries the carriage return of lines that end in both
        ended = raw.withColumn(last, F.regexp_replace(F.col(f"`{last}`"), "\r$", ""))
        ended = ended.withColumn(last, F.when(F.col(f"`{last}`") != "", F.col(f"`{last}`")))
        model = {h: h.strip(_AROUND) for h in ended.columns if h.strip(_AROUND) in OPTIONAL_COLUMNS}
        parts.append(align(ended.withColumnsRenamed({**model, **names})))
    if not parts:
        raise ValueError(f"no lines below {path}")
    return reduce(DataFrame.unionByName, parts)


def read_years(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """`{source year: path}` -> one frame tagged with `source_year`.

    Headers differ between files (in order, and some carry a byte order mark), so they
    are bound to the stage names before the union.
    """
    tagged = [read_raw_csv(spark, path).withColumn("source_year", F.lit(year))
              for year, path in sorted(folders.items())]
    return reduce(DataFrame.unionByName, tagged)


def raw_line_counts(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """Data lines per source year: all lines that are not blank, less one header line per file."""
    per_file = [_lines(spark, path).groupBy(F.lit(year).alias("source_year"), "file")
                .agg((F.count("*") - 1).alias("n"))
                for year, path in sorted(folders.items())]
    return (reduce(DataFrame.unionByName, per_file)
            .groupBy("source_year").agg(F.sum("n").alias("raw_lines")))


def reconcile_lines(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """Data lines against staged rows per source year; a year without any staged row has null."""
    counts = staged.groupBy("source_year").agg(F.count("*").alias("staged_rows"))
    same = F.col("raw_lines").eqNullSafe(F.col("staged_rows"))
    return raw.join(counts, "source_year", "left").withColumn("status", F.when(same, "ok").otherwise("FAIL"))
