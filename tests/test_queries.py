"""Registered queries against their check SQL on the smallest test tables.

All of them run with TIDEWHEEL_ALL_QUERIES=1; without it, a cross-section does.
"""

from __future__ import annotations

import os
import re
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from compare import difference, duck

FOLDER = "/root/testdata/sf0.001"
SOME = ["csv_extract", "partition_overwrite", "clean_stage", "dim_station", "fact_surrogate_key", "star_join_season",
        "orphan_keys", "manifest_reconcile", "duration_quantiles", "station_pool", "zero_filled_panel",
        "prior_year_features", "split_summary", "cost_metrics", "demand_bands", "bootstrap_ci", "request_validation",
        "expand_requests"]
CHECKED = sorted(entry.oracle_sql()) if os.environ.get("TIDEWHEEL_ALL_QUERIES") else SOME

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_check(spark, con, name):
    assert difference(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER) is None


@pytest.mark.parametrize("name", ["prior_year_features", "orphan_keys", "request_validation", "fact_typed"])
def test_plans_have_no_products_and_no_python(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|EvalPython|MapInPandas", plan)


@pytest.mark.parametrize("name", ["star_join_season", "fact_surrogate_key", "prior_year_features", "expand_requests",
                                  "filter_funnel"])
def test_results_do_not_depend_on_broadcasts_by_size(spark, con, name):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert difference(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER) is None
    finally:
        spark.conf.set(key, before)


def test_entry_point(spark):
    result = entry.entry(spark)
    assert result.columns == ["dim_date_season", "dim_user_type_name", "trips", "avg_min"] and result.count() > 0


def test_entry_imports_without_a_session():
    subprocess.run([sys.executable, "-c", "import __spark_entry__"], check=True,
                   cwd=os.path.dirname(entry.__file__), timeout=120)


def test_raw_files_are_compressed_and_name_their_years(spark):
    from tidewheel.queries import stage

    folders = stage.csv_folders(spark, FOLDER)
    raw = stage.raw_stage(spark, FOLDER)
    assert list(folders) == sorted(r[0] for r in raw.select("source_year").distinct().collect())
    files = [f for path in folders.values() for f in spark.read.text(path).inputFiles()]
    assert files and all(f.endswith(".csv.lz4") for f in files)


@pytest.mark.parametrize("name", ["fact_typed", "quantile_cells", "split_contract"])
def test_queries_leave_methods_too_long_to_be_compiled(spark, name):
    """HotSpot interprets methods of more than 8000 bytes of code, however often they run."""
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    entry.queries()[name](spark, FOLDER)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_a_limit_the_user_has_set_stays(spark):
    from tidewheel.session import bound_methods
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "4000")
    try:
        bound_methods(spark)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "4000"
    finally:
        spark.conf.unset("spark.sql.codegen.hugeMethodLimit")


def test_an_export_builds_its_dimensions_once(spark):
    """They are written and counted, so what the export is given has to be read from files."""
    from tidewheel.queries.warehouse import export_sources
    for name, frame in export_sources(spark, FOLDER).items():
        if name in ("dim_date", "dim_station", "dim_bike"):
            plan = frame._jdf.queryExecution().optimizedPlan().toString()
            assert plan.startswith("Relation"), f"{name}: {plan}"


def test_a_split_contract_passes_over_the_trips_once(spark, monkeypatch):
    from tidewheel.queries import standins
    passes = []
    counts = standins.panel.daily_counts
    monkeypatch.setattr(standins.panel, "daily_counts", lambda trips: passes.append(1) or counts(trips))
    entry.queries()["split_contract"](spark, FOLDER)
    assert len(passes) == 1
