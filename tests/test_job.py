from __future__ import annotations

import os
import subprocess
import sys

import pytest

import trip_rows
from waybill.plans import job, reports
from waybill.sinks.parquet import report_path, write_report
from waybill.sources import lineitem
from waybill.sources.parquet import read_trips


@pytest.fixture(scope="module")
def inputs(spark, sf_dir, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("inputs"))
    for service in ("green", "yellow"):
        lineitem.trips(spark, sf_dir, service).write.parquet(f"{base}/{service}/2020/01")
    lineitem.zones(spark, sf_dir).write.parquet(f"{base}/zones")
    return {"input_green": f"{base}/green/*/*", "input_yellow": f"{base}/yellow/2020/*"} | {
        "input_zones": f"{base}/zones"
    }


# Report directories.
DIRECTORIES = {
    "trips_per_service_type_report",
    "fare_analysis_report",
    "yoy_trip_volume_report",
    "speed_by_zone_report",
    "top_pickup_zones_report",
    "top_dropoff_zones_report",
    "payment_behavior_report",
    "hourly_patterns_report",
    "ratecode_analysis_report",
    "congestion_impact_report",
}


def rows(spark, path):
    return sorted(map(str, spark.read.parquet(path).collect()))


def test_job_writes_ten_reports_and_replaces_them(spark, inputs, tmp_path):
    outputs = {}
    for shared in (True, False):
        output = str(tmp_path / str(shared))
        for _ in range(2):
            outputs[shared] = job.run(
                spark, **inputs, output=output + "/", shared_scan=shared, staging=f"{tmp_path}/s"
            )
        assert {name for name in os.listdir(output) if name[0] != "."} == DIRECTORIES
    for report in reports.REPORTS:
        first, second = (rows(spark, outputs[shared][report.name]) for shared in (True, False))
        assert first == second
        assert first


def listing(folder):
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_summary_is_staged_in_the_given_folder(spark, inputs, tmp_path):
    job.run(spark, **inputs, output=str(tmp_path / "out"), staging=str(tmp_path / "staging"))
    (staged,) = (name for name in listing(tmp_path / "staging") if name[0] != ".")
    slices = {name for name in listing(tmp_path / "staging" / staged) if name.startswith("slice=")}
    assert slices == {"slice=codes", "slice=pickup", "slice=dropoff", "slice=clock"}


def test_staging_folder(spark):
    default = spark.conf.get(job.CHECKPOINT_SETTING, None)
    if default:
        assert job.staging_folder(spark, None, "/out") == default
    else:
        with pytest.raises(ValueError, match="shared staging folder"):
            job.staging_folder(spark, None, "/out")
    assert job.staging_folder(spark, "/outer", "/out") == "/outer"
    for inside in ("/out", "/out/", "/out/tmp"):
        with pytest.raises(ValueError, match="lies in the output"):
            job.staging_folder(spark, inside, "/out")


def test_raw_counts_are_logged_both_ways(spark, inputs, tmp_path, caplog):
    for shared in (True, False):
        caplog.clear()
        with caplog.at_level("INFO", logger=job.log.name):
            job.run(
                spark, **inputs, output=f"{tmp_path}/o", shared_scan=shared, staging=f"{tmp_path}/s"
            )
        (line,) = (m for m in caplog.messages if m.startswith("trips read"))
        assert "'green'" in line and "'yellow'" in line and "6000 in all" in line


@pytest.mark.parametrize("way", ["option", "setting"])
def test_command_line(inputs, tmp_path, way):
    """The summary goes to the staging folder or else to the checkpoint folder."""
    conf = f"--conf spark.checkpoint.dir={tmp_path}/setting"
    (tmp_path / "conf").mkdir()
    options = [f"--{name}={path}" for name, path in inputs.items()]
    options += [f"--staging={tmp_path}/option"] if way == "option" else []
    submit = f"--master local[2] --conf spark.ui.enabled=false {conf} pyspark-shell"
    subprocess.run(
        [sys.executable, "-m", "waybill.plans.job", *options, f"--output={tmp_path}/out/"],
        check=True,
        timeout=300,
        cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
        env={
            **os.environ,
            "PYSPARK_SUBMIT_ARGS": submit,
            "SPARK_CONF_DIR": str(tmp_path / "conf"),
        },
    )
    assert DIRECTORIES <= listing(tmp_path / "out")
    staged = listing(tmp_path / way)
    assert sum(name.startswith("_trip_summary") for name in staged) == 1


def test_no_trips_at_all(spark, inputs, tmp_path):
    empty = {}
    for service in ("green", "yellow"):
        empty[f"input_{service}"] = f"{tmp_path}/{service}"
        none = trip_rows.raw(spark, {}, service=service).limit(0)
        none.write.parquet(f"{tmp_path}/{service}")
    for shared in (True, False):
        written = job.run(
            spark, **{**inputs, **empty}, output=f"{tmp_path}/out", shared_scan=shared, staging=f"{tmp_path}/s"
        )
        assert [rows(spark, path) for path in written.values()] == [[]] * 10


def test_decimal_amounts_and_a_second_number_type(spark, inputs, tmp_path):
    """Sources may store the same column with different number types."""
    paths = {}
    for service, amount, code in (("green", "decimal(10,2)", "int"), ("yellow", "double", "double")):
        paths[f"input_{service}"] = f"{tmp_path}/{service}"
        raw = trip_rows.raw(spark, {}, {"total_amount": 20.11}, service=service)
        raw = raw.withColumns(
            {
                "total_amount": raw["total_amount"].cast(amount),
                "RatecodeID": raw["RatecodeID"].cast(code),
                "trip_distance": raw["trip_distance"].cast("float"),
            }
        )
        raw.write.parquet(paths[f"input_{service}"])
    outcomes = []
    for shared in (True, False):
        written = job.run(
            spark, **{**inputs, **paths}, output=f"{tmp_path}/{shared}", shared_scan=shared, staging=f"{tmp_path}/s"
        )
        outcomes.append([rows(spark, path) for path in written.values()])
    assert outcomes[0] == outcomes[1]
    report = spark.read.parquet(written["ratecode_analysis"])
    assert [tuple(row) for row in report.collect()] == [(1.0, 4, 15.0, 2.0, 3.0, 0.08)]


def test_failure_reaches_the_caller(spark, inputs, tmp_path):
    broken = {**inputs, "input_zones": str(tmp_path / "missing")}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        job.run(spark, **broken, output=f"{tmp_path}/o", staging=f"{tmp_path}/s")


def test_all_four_paths_are_required(capsys):
    with pytest.raises(SystemExit):
        job.main(["--input_green", "a", "--input_yellow", "b", "--output", "c"])
    assert "--input_zones" in capsys.readouterr().err


@pytest.mark.parametrize("base", ["/data/out", "/data/out/", "/data/out//"])
def test_report_path(base):
    assert report_path(base, "fare_analysis") == "/data/out/fare_analysis_report"


def test_overwrite(spark, tmp_path):
    for n in (5, 2):
        path = write_report(spark.range(n), str(tmp_path), "x")
    assert spark.read.parquet(path).count() == 2


def test_reading_a_file_a_directory_and_a_glob(spark, tmp_path):
    for part in ("a", "b"):
        trip_rows.raw(spark, {}).coalesce(1).write.parquet(f"{tmp_path}/{part}")
    (name,) = (f for f in os.listdir(tmp_path / "a") if f.endswith(".parquet"))
    assert read_trips(spark, f"{tmp_path}/a/{name}").count() == 1
    assert read_trips(spark, f"{tmp_path}/a").count() == 1
    assert read_trips(spark, f"{tmp_path}/*").count() == 2
