"""What the physical plans must and must not contain."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

import pytest
import __spark_entry__ as contract
import trip_rows
from waybill.operators.normalize import canonical_trips, normalize, normalize_all
from waybill.operators.quality import clean_trips
from waybill.plans import job, reports, summary
from waybill.sources import lineitem
from waybill.sources.parquet import read_trips, read_zones


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("stored"))
    for service in ("green", "yellow"):
        lineitem.trips(spark, sf_dir, service).write.parquet(f"{base}/{service}")
    lineitem.zones(spark, sf_dir).write.parquet(f"{base}/zones")
    return base


def raw(spark, stored):
    return {s: read_trips(spark, f"{stored}/{s}") for s in ("green", "yellow")}


def plan(frame, capsys):
    frame.explain("formatted")
    return capsys.readouterr().out


def report_plan(spark, stored, report, capsys):
    clean = clean_trips(canonical_trips(raw(spark, stored)))
    return plan(reports.build(report, clean, read_zones(spark, f"{stored}/zones")), capsys)


def read_columns(text):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", text)
    return [{column.split(":")[0] for column in schema.split(",")} for schema in schemas]


TIMES = {"pickup_datetime", "dropoff_datetime"}
VALIDITY = {*TIMES, "RatecodeID", "trip_distance"}
NEEDED = {
    "trips_per_service_type": {"pickup_datetime", "RatecodeID"},
    "fare_analysis": {"RatecodeID", "payment_type", "total_amount", "fare_amount", "tip_amount"}
    | {"tolls_amount", "congestion_surcharge"},
    "yoy_trip_volume": {"RatecodeID", "pickup_datetime", "total_amount", "trip_distance"},
    "speed_by_zone": VALIDITY | {"PULocationID"},
    "top_pickup_zones": VALIDITY | {"PULocationID", "total_amount"},
    "top_dropoff_zones": VALIDITY | {"DOLocationID", "total_amount"},
    "payment_behavior": VALIDITY | {"payment_type", "tip_amount", "total_amount"},
    "hourly_patterns": VALIDITY | {"total_amount", "tip_amount"},
    "ratecode_analysis": VALIDITY | {"fare_amount", "tip_amount", "total_amount"},
    "congestion_impact": VALIDITY | {"total_amount", "fare_amount", "congestion_surcharge"},
}


@pytest.mark.parametrize("report", reports.REPORTS, ids=lambda r: r.name)
def test_scans_read_only_what_the_report_needs(spark, stored, report, capsys):
    columns = read_columns(report_plan(spark, stored, report, capsys))
    for prefix, read in zip(("lpep_", "tpep_"), columns):
        wanted = NEEDED[report.name]
        assert read == {prefix + c if c in TIMES else c for c in wanted}


@pytest.mark.parametrize("report", reports.REPORTS, ids=lambda r: r.name)
def test_rate_code_filter_reaches_both_scans(spark, stored, report, capsys):
    text = report_plan(spark, stored, report, capsys)
    assert text.count("Not(EqualTo(RatecodeID,99))") == 2


def test_start_date_reaches_both_scans(spark, stored, capsys):
    text = report_plan(spark, stored, reports.TRIPS_PER_SERVICE, capsys)
    for column in ("lpep_pickup_datetime", "tpep_pickup_datetime"):
        assert f"GreaterThanOrEqual({column},2020-01-01T00:00)" in text


def test_start_date_reaches_the_scan_of_zoned_times(spark, tmp_path, capsys):
    trip_rows.raw(spark, {}, time="timestamp").write.parquet(f"{tmp_path}/green")
    green = normalize(read_trips(spark, f"{tmp_path}/green"), "green")
    text = plan(reports.build(reports.TRIPS_PER_SERVICE, clean_trips(green)), capsys)
    assert "GreaterThanOrEqual(lpep_pickup_datetime,2020-01-01" in text


@pytest.mark.parametrize("report", reports.REPORTS, ids=lambda r: r.name)
def test_trips_are_aggregated_before_the_first_hash_shuffle(spark, stored, report, capsys):
    """A second one, by the keys without the layer, moves the groups of the first."""
    text = report_plan(spark, stored, report, capsys)
    assert "partial_" in text
    shuffles = re.findall(r"Arguments: hashpartitioning\((.*?)\), ENSURE", text)
    assert len(shuffles) == (2 if report.measures else 1)
    assert not report.measures or sum("layer" in keys for keys in shuffles) == 1


@pytest.mark.parametrize("report", [reports.TOP_PICKUP, reports.TOP_DROPOFF], ids=lambda r: r.name)
def test_zones_are_broadcast_only_below_the_threshold(spark, stored, report, capsys):
    text = report_plan(spark, stored, report, capsys)
    assert "BroadcastHashJoin LeftOuter BuildRight" in text
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        text = report_plan(spark, stored, report, capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Broadcast" not in text
    assert "SortMergeJoin LeftOuter" in text


def test_speed_is_rounded_only_where_it_is_shown(spark, stored, capsys):
    for report, shown in (
        (reports.FARES, False),
        (reports.SPEED_BY_ZONE, True),
        (reports.PAYMENT_BEHAVIOR, False),
    ):
        text = report_plan(spark, stored, report, capsys)
        assert ("avg_speed_mph" in text) == shown


def test_summary_scans_each_source_once(spark, stored, capsys):
    text = plan(summary.summarize(normalize_all(raw(spark, stored))), capsys)
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 2
    assert tree.count("Expand") == 2
    assert text.count("Arguments: hashpartitioning") == 2
    assert [len(columns) for columns in read_columns(text)] == [12, 12]


def test_report_reads_its_slice_of_the_staged_summary_only(spark, stored, tmp_path, capsys):
    services = normalize_all(raw(spark, stored))
    staged = job.stage(spark, summary.summarize(services), str(tmp_path))
    for report in reports.REPORTS:
        zones = read_zones(spark, f"{stored}/zones")
        text = plan(summary.report_from_summary(report, staged, zones), capsys)
        assert "(slice#" in text
        assert f"= {summary.slice_of(report)})" in text
        assert "PartitionFilters" in text


def test_summary_for_one_report_reads_only_what_it_needs(spark, stored, capsys):
    services = normalize_all(raw(spark, stored))
    text = plan(summary.summarize(services, reports=[reports.TOP_DROPOFF]), capsys)
    for prefix, read in zip(("lpep_", "tpep_"), read_columns(text)):
        wanted = NEEDED["top_dropoff_zones"]
        assert read == {prefix + c if c in TIMES else c for c in wanted}
    assert "avg_speed_mph" not in text


@pytest.mark.parametrize("key", contract.trip_queries())
def test_no_python_workers_and_no_cross_joins(spark, sf_dir, key, capsys):
    text = plan(contract.trip_queries()[key](spark, sf_dir), capsys)
    for unwanted in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text
    for line in text.splitlines():
        assert "SinglePartition" not in line


def test_written_plans(spark, sf_dir, tmp_path, monkeypatch, capsys):
    """What the job and the sink write, before it is read back."""
    plans = []

    def explained(write):
        def recorded(frame, *args):
            plans.append(plan(frame, capsys))
            return write(frame, *args)

        return recorded

    monkeypatch.setattr(job, "write_report", explained(job.write_report))
    services, zones = lineitem.services(spark, sf_dir), lineitem.zones(spark, sf_dir)
    staging = str(tmp_path / "staging")
    summarized = plan(summary.summarize(normalize_all(services)), capsys)
    with monkeypatch.context() as patch:
        patch.setattr(job, "ThreadPoolExecutor", lambda _: ThreadPoolExecutor(1))
        job.write_reports(services, zones, str(tmp_path / "out"), staging=staging)
    assert len(plans) == len(reports.REPORTS)
    for text in [*plans, summarized]:
        for unwanted in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin"):
            assert unwanted not in text
        assert "SinglePartition" not in text
