"""From CSV files to answered requests on a small invented network."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest

from tidewheel import __main__ as command_line
from tidewheel.contract import RAW_HEADERS
from tidewheel.operators.models import BoostParams
from tidewheel.plans import service, study, warehouse

YEARS = ["2019", "2020", "2021", "2022"]
SCOPE = study.StudyScope("2019-01-31", "2022-12-01", {"train": [2019, 2020], "val": [2021], "test": [2022]}, "annual", 3)


@pytest.fixture(scope="module")
def network(tmp_path_factory):
    root = tmp_path_factory.mktemp("network")
    rng, number = random.Random(4), 0
    for year in YEARS:
        lines = ["﻿" + ",".join(RAW_HEADERS)]
        for month in range(1, 13):
            for station, rate in ((7000, 6), (7001, 4), (7002, 2), (7003, 1)):
                if station == 7003 and year == "2019":
                    continue
                for day in (2, 15):
                    for _ in range(rate):
                        number += 1
                        start = dt.datetime(int(year), month, day, rng.choice([8, 8, 17, 12]), rng.randrange(60))
                        end = start + dt.timedelta(seconds=700)
                        kind = "Annual Member" if rng.random() < 0.8 else "Casual Member"
                        lines.append(f"{number},700,{start:%m/%d/%Y %H:%M},{station},Dock {station},"
                                     f"{end:%m/%d/%Y %H:%M},7001,NULL,{number % 9},{kind}")
        lines.append("x,700,01/02/2019 08:00,7000,Dock,,7001,Dock,1,Annual Member")
        folder = root / "raw" / year
        folder.mkdir(parents=True)
        (folder / "trips.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return root


def test_csv_to_forecast(spark, network):
    folders = {y: f"{network}/raw/{y}/*.csv" for y in YEARS}
    export, out = f"{network}/export", f"{network}/out"
    reports = warehouse.build(spark, folders, f"{network}/warehouse", export)
    audit = reports["clean_audit"].first()
    assert audit.dropped_rows == len(YEARS) and audit.before_rows == audit.after_rows + len(YEARS)
    for name in ("stage", "dim_date", "dim_station", "dim_bike", "fact", "orphans", "export"):
        assert reports[name].where("status <> 'ok'").count() == 0, name
    names = {r.dim_station_id: r.dim_station_name for r in spark.read.parquet(f"{export}/dim_station").collect()}
    assert names == {s: f"Dock {s}" for s in (7000, 7001, 7002, 7003)}

    made = study.prepare(spark, export, out, SCOPE)
    assert {r.station_id for r in made["pool"].collect()} == {7000, 7001, 7002}
    assert set(made["cleaned"].columns) == {"station_id", "start_date", "hour", "year"}
    contract = study.read_contract(spark, out)
    assert contract["station_pool"] == [7000, 7001, 7002] and contract["baseline_val_mae"] > 0

    quick = dict(rounds=3, depth=3, min_samples_leaf=5)
    study.train(spark, out, "poisson", BoostParams(**quick))
    study.train(spark, out, "q80", BoostParams(loss="quantile", quantile=0.8, **quick))
    result = study.evaluate(spark, out, ["poisson", "q80"], {"q80": 0.8}, "poisson", "q80")
    assert {r.model for r in result["accuracy"].collect()} == {"baseline", "poisson", "q80"}
    assert [r.model for r in result["verdict"].where("recommended").collect()] == ["q80"]
    steps = [["ablation", "--rounds", "2", "--leaves", "4"], ["sweep", "--name", "best", "--rounds-divisor", "300"],
             ["regression"], ["importance", "--name", "poisson", "--repeats", "1"], ["interval", "--name", "poisson"],
             ["evaluate", "--names", "poisson", "q80", "--quantiles", "q80=0.8", "--reference", "poisson",
              "--recommended", "q80"]]
    for step in steps:
        command_line.main([step[0], "--out", out, *step[1:]])
    board = spark.read.parquet(f"{out}/reports/ablation").collect()
    assert {r.model for r in board} == {"baseline", "calendar", "calendar+py"}
    assert spark.read.parquet(f"{out}/reports/sweep").count() == 8
    assert {r.split for r in spark.read.parquet(f"{out}/reports/regression").collect()} == {"val", "test"}
    assert spark.read.parquet(f"{out}/reports/importance").count() == len(contract["features"])
    assert spark.read.parquet(f"{out}/reports/interval").count() == 1
    record = spark.read.parquet(f"{out}/runs").where("run = 'poisson'").first().params
    assert record["test_years"] == "2022" and int(record["train_rows"]) > 0 and ":" in record["train_digest"]
    runs = spark.read.parquet(f"{out}/runs").where("run <> 'best'")
    assert {r.run for r in runs.select("run").distinct().collect()} == {"poisson", "q80"}

    service.build_lookups(spark, out, export, 2022)
    good = {"station_id": 7000, "date": "2023-07-19", "hour": 8}
    batch = spark.createDataFrame([(1, json.dumps([good, {**good, "hour": 3}])),
                                   (2, json.dumps({**good, "station_id": 7003}))], "request_id int, body string")
    predictions, refusals = service.forecast(spark, out, "q80", batch)
    answered = {(r.request_id, r.position): r.prediction for r in predictions.collect()}
    assert set(answered) == {(1, 0), (1, 1)} and answered[(1, 0)] > answered[(1, 1)] >= 0
    assert [tuple(r) for r in refusals.collect()] == [(2, "unknown station_id: 7003")]


def test_failed_checks_stop_the_flow(spark):
    report = spark.createDataFrame([("a", "ok"), ("b", "FAIL")], "check string, status string")
    with pytest.raises(warehouse.FailedChecks, match="'b'"):
        warehouse.require_ok(report, "demo")


def test_a_failed_suite_stops_before_the_export(spark, network, tmp_path, monkeypatch):
    lost = spark.createDataFrame([("dim_bike", 1, "FAIL")], "dimension string, orphans int, status string")
    warned = spark.createDataFrame([(warehouse.WARNINGS[0], 3, "FAIL")], "check string, violations int, status string")
    monkeypatch.setattr(warehouse, "confirm", lambda _: {"fact": warned, "orphans": lost})
    folders = {"2019": f"{network}/raw/2019/*.csv"}
    with pytest.raises(warehouse.FailedChecks, match="orphans"):
        warehouse.build(spark, folders, f"{tmp_path}/warehouse", f"{tmp_path}/export")
    assert not (tmp_path / "export").exists()


def test_a_split_that_breaks_its_contract_is_not_trained_on(spark, tmp_path):
    rows = [("train", dt.date(2020, 5, 1), 1), ("val", dt.date(2020, 5, 1), 2), ("test", dt.date(2022, 1, 1), 3)]
    spark.createDataFrame(rows, "split string, start_date date, trip_count int").write.parquet(f"{tmp_path}/split")
    contract = {"features": [], "target": "trip_count", "test_years": [2022]}
    spark.createDataFrame([(json.dumps(contract),)], "value string").write.text(f"{tmp_path}/contract")
    with pytest.raises(study.BrokenSplit, match="train and val overlap"):
        study.checked_split(spark, str(tmp_path))
    contract["features"] = ["hour"]
    spark.createDataFrame([(json.dumps(contract),)], "value string").write.mode("overwrite").text(f"{tmp_path}/contract")
    with pytest.raises(study.BrokenSplit, match="hour"):
        study.checked_split(spark, str(tmp_path))
