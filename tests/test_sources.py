from __future__ import annotations

import codecs
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tidewheel import session as tw_session
from tidewheel.contract import RAW_HEADERS, STAGE_COLUMNS, STAGE_PARTITIONS, STAGE_SCHEMA
from tidewheel.sources import csvs, exports, records, tables

HEADER = ",".join(RAW_HEADERS)
LINE = "{id},730,01/05/2019 08:10,7000,A St,01/05/2019 08:22,7001,B St,12,Annual Member"


def write(path, lines, bom=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((codecs.BOM_UTF8 if bom else b"") + ("\n".join(lines) + "\n").encode())


def test_years_with_and_without_bom(spark, tmp_path):
    write(tmp_path / "2019" / "a.csv", [HEADER, LINE.format(id=1), LINE.format(id=2)], bom=True)
    write(tmp_path / "2019" / "b.csv", [HEADER, LINE.format(id=3)], bom=True)
    write(tmp_path / "2020" / "a.csv", [HEADER, LINE.format(id=4)])
    folders = {y: f"{tmp_path}/{y}/*.csv" for y in ("2019", "2020")}
    stage = csvs.read_years(spark, folders)
    assert stage.columns == STAGE_COLUMNS + ["source_year"]
    assert sorted((r.trip_id, r.source_year, r.model) for r in stage.collect()) == [
        ("1", "2019", None), ("2", "2019", None), ("3", "2019", None), ("4", "2020", None)]
    assert {r.source_year: r.raw_lines for r in csvs.raw_line_counts(spark, folders).collect()} == {"2019": 3, "2020": 1}


def test_carriage_returns_and_blank_lines_are_no_rows(spark, tmp_path):
    (tmp_path / "2019").mkdir()
    body = [HEADER, LINE.format(id=1) + "\r", "", LINE.format(id=2), "  ", LINE.format(id=3)]
    (tmp_path / "2019" / "a.csv").write_bytes("\r\n".join(body).encode() + b"\r\n\r\n")
    folders = {"2019": f"{tmp_path}/2019/*.csv"}
    got = csvs.read_years(spark, folders).select("trip_id", "user_type").collect()
    assert sorted((r.trip_id, r.user_type.rstrip("\r")) for r in got) == [("1", "Annual Member"), ("2", "Annual Member"), ("3", "Annual Member")]
    assert [r.raw_lines for r in csvs.raw_line_counts(spark, folders).collect()] == [3]


def test_files_of_a_year_may_order_their_headers_differently(spark, tmp_path):
    write(tmp_path / "2019" / "a.csv", [HEADER, LINE.format(id=1)])
    names, values = HEADER.split(","), LINE.format(id=2).split(",")
    turned = list(reversed(range(len(names))))
    write(tmp_path / "2019" / "b.csv", [",".join(names[i] for i in turned), ",".join(values[i] for i in turned)], bom=True)
    got = csvs.read_raw_csv(spark, f"{tmp_path}/2019/*.csv").drop("trip_id").distinct().collect()
    assert len(got) == 1 and got[0].trip_duration == "730" and got[0].user_type == "Annual Member"
    write(tmp_path / "2019" / "c.csv", [HEADER.replace(",Bike Id", ""), "1,2,3,4,5,6,7,8,9"])
    with pytest.raises(ValueError, match="c.csv lacks .*bike_id"):
        csvs.read_raw_csv(spark, f"{tmp_path}/2019/*.csv")


def test_missing_header_is_named(spark, tmp_path):
    write(tmp_path / "2019" / "a.csv", [HEADER.replace(",Bike Id", ""), "1,2,3,4,5,6,7,8,9"])
    with pytest.raises(ValueError, match="bike_id"):
        csvs.read_raw_csv(spark, f"{tmp_path}/2019/*.csv")


def test_extra_headers_are_ignored():
    assert csvs.header_names(["﻿Trip Id", *list(RAW_HEADERS)[1:], "Colour"])["﻿Trip Id"] == "trip_id"


def stage_rows(spark, *pairs):
    return spark.createDataFrame([(i, year) for i, year in pairs], "trip_id string, source_year string").select(
        *[F.col(c) if c in ("trip_id", "source_year") else F.lit("x").alias(c) for c in STAGE_SCHEMA.names])


def test_dynamic_overwrite_replaces_only_present_partitions(spark, tmp_path):
    path = f"{tmp_path}/stage"
    tables.write_partitioned(stage_rows(spark, ("1", "2019"), ("2", "2020")), path, STAGE_PARTITIONS, dynamic=True)
    tables.write_partitioned(stage_rows(spark, ("3", "2020")), path, STAGE_PARTITIONS, dynamic=True)
    assert sorted(r.trip_id for r in spark.read.parquet(path).collect()) == ["1", "3"]


def test_one_partition_can_become_empty(spark, tmp_path):
    path = f"{tmp_path}/stage"
    both = stage_rows(spark, ("1", "2019"), ("2", "2020"))
    tables.write_partitioned(both, path, STAGE_PARTITIONS)
    tables.replace_partition(both.where("false"), path, source_year="2020")
    assert [r.trip_id for r in spark.read.parquet(path).collect()] == ["1"]


def test_swap_reads_its_own_table_and_drops_emptied_partitions(spark, tmp_path):
    location = f"{tmp_path}/stage"
    tables.create_versioned(spark, "swap_me", STAGE_SCHEMA, location, STAGE_PARTITIONS)
    assert spark.table("swap_me").count() == 0
    tables.write_partitioned(stage_rows(spark, ("1", "2019"), ("2", "2020")), location, STAGE_PARTITIONS, dynamic=True)
    tables.register_partitions(spark, "swap_me")
    tables.swap_table(spark.table("swap_me").where("trip_id = '1'"), "swap_me", STAGE_PARTITIONS, root=location)
    assert [r.trip_id for r in spark.table("swap_me").collect()] == ["1"]
    assert not (tmp_path / "stage").exists()  # the folder it replaced
    again = tables.swap_table(spark.table("swap_me").withColumn("model", F.lit("m")), "swap_me", STAGE_PARTITIONS)
    assert [(r.trip_id, r.model) for r in spark.table("swap_me").collect()] == [("1", "m")]
    assert spark.read.parquet(again).count() == 1


def test_a_swap_that_stops_anywhere_leaves_the_old_table_or_the_new_one(spark, tmp_path, monkeypatch):
    real, done, seen = type(spark).sql, False, set()
    for stop in range(1, 40):
        location = f"{tmp_path}/{stop}"
        tables.create_versioned(spark, "stops", STAGE_SCHEMA, location, STAGE_PARTITIONS)
        tables.write_partitioned(stage_rows(spark, ("1", "2019"), ("2", "2020")), location, STAGE_PARTITIONS, dynamic=True)
        tables.register_partitions(spark, "stops")
        left = [stop]

        def limited(self, *args, **more):
            left[0] -= 1
            if not left[0]:
                raise RuntimeError("killed")
            return real(self, *args, **more)

        with monkeypatch.context() as patch:
            patch.setattr(type(spark), "sql", limited)
            try:
                tables.swap_table(spark.table("stops").where("trip_id = '1'"), "stops", STAGE_PARTITIONS, root=location)
                done = True
            except RuntimeError:
                pass
        ids = tuple(sorted(r.trip_id for r in spark.table("stops").collect()))
        assert ids == ("1",) if done else ids in (("1", "2"), ("1",))
        seen.add(ids)
        if done:
            break
    assert done and stop > 5 and seen == {("1", "2"), ("1",)}
    assert len(spark.sql("SHOW TABLES LIKE 'stops__*'").collect()) == 1


def test_export_manifest_reconciles_and_notices_loss(spark, tmp_path):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "dim_station_id int, dim_station_name string")
    fact = spark.createDataFrame([(1, 2019, 1), (2, 2019, 2)], "fact_trip_id int, start_year int, start_month int")
    manifest = exports.export_tables({"dim_station": dim, "fact_trip": fact}, f"{tmp_path}/export")
    by_name = {r.table_name: r for r in manifest.collect()}
    assert (by_name["fact_trip"].row_count, by_name["fact_trip"].column_count) == (2, 3)
    assert by_name["fact_trip"].partitioned_by == "start_year,start_month"
    found = exports.read_export(spark, f"{tmp_path}/export", ["dim_station", "fact_trip"])
    assert exports.reconcile(found, manifest).where("status <> 'ok'").count() == 0
    found["dim_station"] = found["dim_station"].where("dim_station_id = 1")
    assert [r.table_name for r in exports.reconcile(found, manifest).where("status = 'FAIL'").collect()] == ["dim_station"]


def test_fingerprint_ignores_order_and_sees_pairs(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    digest = records.fingerprint(a, ["a", "b"]).first()
    assert records.fingerprint(a.orderBy(F.desc("a")), ["a", "b"]).first() == digest
    doubled = records.fingerprint(a.union(a).union(a), ["a", "b"]).first()
    assert doubled.xor_digest == digest.xor_digest and doubled.sum_digest != digest.sum_digest


def test_run_records_append(spark, tmp_path):
    scores = spark.createDataFrame([("test", "mae", 0.5)], "split string, metric string, value double")
    for run in ("a", "b"):
        records.log_run(scores, f"{tmp_path}/runs", run, {"depth": 3})
    assert sorted((r.run, r.value, r.params["depth"]) for r in records.read_runs(spark, f"{tmp_path}/runs").collect()) == [
        ("a", 0.5, "3"), ("b", 0.5, "3")]


def test_lookup_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(7, 1, 2.0), (7, 1, 4.0)], "s int, h int, v double")
    records.write_lookup(records.to_lookup(df, ["s", "h"], F.avg("v")), f"{tmp_path}/l")
    assert [tuple(r) for r in records.read_lookup(spark, f"{tmp_path}/l").collect()] == [("7|1", 3.0)]


def test_shared_folder_comes_from_the_session(spark):
    assert tw_session.work_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert tw_session.scratch_path(spark, "x").startswith(tw_session.work_dir(spark))


def test_schema_table_keeps_order(spark):
    assert [tuple(r) for r in tables.schema_table(stage_rows(spark, ("1", "2019"))).collect()][:2] == [
        (1, "trip_id", "string"), (2, "trip_duration", "string")]


def test_a_local_warehouse_is_refused_on_a_cluster(spark):
    assert tw_session.needs_shared_folder("spark://host:7077", "file") and tw_session.needs_shared_folder("yarn", "file")
    assert tw_session.needs_shared_folder("local-cluster[2,1,1024]", "file")
    assert not tw_session.needs_shared_folder("local[4]", "file") and not tw_session.needs_shared_folder("yarn", "s3a")
    assert not tw_session.needs_shared_folder("local", "file") and tw_session.work_dir(spark)


def test_entry_survives_a_missing_package(tmp_path):
    (tmp_path / "public_tokenizers.py").write_text("raise ImportError('no vocabulary files')\n")
    found = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), 'op5_token_counts' in e.queries())"],
        cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), capture_output=True, text=True, timeout=120,
        env={**os.environ, "PYTHONPATH": str(tmp_path)})
    count, has = found.stdout.split()
    assert int(count) > 100 and has == "False"
