"""Raw yearly CSV folders -> stage -> clean stage -> star schema -> export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewheel.contract import STAGE_PARTITIONS, STAGE_SCHEMA, STAR_COLUMNS, STAR_PARTITIONS
from tidewheel.functions.calendar import statutory_holidays
from tidewheel.operators import cleaning, dimensions, facts, quality
from tidewheel.sources import csvs, exports, tables

STAGE = "stage_trips"
# Source ids repeat in the published files, so this check is reported and does not stop the build.
WARNINGS = ["duplicate fact_trip_source_id"]


class FailedChecks(Exception):
    """Raised when a report contains a FAIL row; carries the failing rows as text."""


def require_ok(report: DataFrame, what: str) -> DataFrame:
    """Stop on a failed check. A report has one row per check, so it is safe to collect."""
    failed = report.where("status <> 'ok'").collect()
    if failed:
        raise FailedChecks(f"{what}: " + "; ".join(str(row.asDict()) for row in failed))
    return report


def load_stage(spark: SparkSession, folders: dict[str, str], root: str) -> DataFrame:
    """Load the given years, replacing only their partitions, and prove the line counts."""
    location = f"{root}/{STAGE}"
    tables.create_versioned(spark, STAGE, STAGE_SCHEMA, location, STAGE_PARTITIONS)
    tables.write_partitioned(csvs.read_years(spark, folders), location, STAGE_PARTITIONS, dynamic=True)
    tables.register_partitions(spark, STAGE)
    return csvs.reconcile_lines(csvs.raw_line_counts(spark, folders), spark.table(STAGE))


def clean_stage(spark: SparkSession, root: str) -> DataFrame:
    """Replace the stage by its valid, repaired rows; returns the audit."""
    stage = spark.table(STAGE)
    audit = cleaning.clean_audit(stage).collect()
    tables.swap_table(cleaning.clean(stage), STAGE, STAGE_PARTITIONS, root=f"{root}/{STAGE}")
    return spark.createDataFrame(audit, "before_rows bigint, dropped_rows bigint, after_rows bigint")


def _span_holidays(bounds: DataFrame) -> DataFrame:
    return statutory_holidays(bounds.select(
        F.explode(F.sequence(F.year("first_date"), F.year("last_date"))).alias("year")))


def load_star(spark: SparkSession, root: str, holidays: DataFrame | None = None) -> None:
    """Create the star tables and load dimensions before the fact."""
    tables.create_star(spark, root)
    stage = spark.table(STAGE)
    bounds = dimensions.date_bounds(stage)
    loads = {
        "dim_date": lambda: dimensions.dim_date(bounds, _span_holidays(bounds) if holidays is None else holidays),
        "dim_station": lambda: dimensions.dim_station(dimensions.station_sightings(stage)),
        "dim_bike": lambda: dimensions.dim_bike(stage),
        "dim_user_type": lambda: dimensions.dim_user_type(stage),
        "fact_trip": lambda: facts.build_fact(stage, spark.table("dim_user_type")),
    }
    for name, build in loads.items():
        path = f"{root}/{name}"
        if STAR_PARTITIONS.get(name):
            tables.write_partitioned(build(), path, STAR_PARTITIONS[name])
            tables.register_partitions(spark, name)
        else:
            tables.write_small(build(), path)
            spark.sql(f"REFRESH TABLE {name}")


def confirm(spark: SparkSession) -> dict[str, DataFrame]:
    """All expectation suites over the loaded tables."""
    stage, fact = spark.table(STAGE), spark.table("fact_trip")
    dims = {name: spark.table(name) for name in STAR_COLUMNS if name != "fact_trip"}
    years = dims["dim_date"].agg(F.min("dim_date_year").alias("lo"), F.max("dim_date_year").alias("hi")).first()
    stations = dimensions.station_sightings(stage)
    bikes = stage.select(F.col("bike_id").try_cast("int").alias("bike_id"))
    return {
        "stage": quality.stage_checks(stage),
        "dim_date": quality.dim_date_checks(dims["dim_date"], years["lo"], years["hi"]),
        "dim_station": quality.dimension_checks(dims["dim_station"], "dim_station_id", stations, "station_id"),
        "dim_bike": quality.dimension_checks(dims["dim_bike"], "dim_bike_id", bikes, "bike_id"),
        "fact": quality.fact_checks(fact, stage),
        "orphans": quality.orphans(fact, quality.star_links(dims)),
    }


def export(spark: SparkSession, path: str) -> DataFrame:
    """Export the star, read it back from files and reconcile it with the manifest."""
    star = {name: spark.table(name) for name in STAR_COLUMNS}
    recorded = exports.export_tables(star, path)
    return exports.reconcile(exports.read_export(spark, path, list(STAR_COLUMNS)), recorded)


def build(spark: SparkSession, folders: dict[str, str], root: str, out: str,
          holidays: DataFrame | None = None) -> dict[str, DataFrame]:
    """Everything from CSV to export; returns the reports. A failed check stops before the export."""
    reports = {"raw_lines": require_ok(load_stage(spark, folders, root), "stage load"),
               "clean_audit": clean_stage(spark, root)}
    load_star(spark, root, holidays)
    for name, report in confirm(spark).items():
        reports[name] = report
        require_ok(report.where(~F.col("check").isin(WARNINGS)) if "check" in report.columns else report, name)
    reports["export"] = require_ok(export(spark, out), "export")
    return reports
