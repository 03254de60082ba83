"""Files left out by the table of their last times."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import trip_rows
from waybill.operators.normalize import normalize
from waybill.operators.quality import since
from waybill.plans import job
from waybill.sources.parquet import read_trips, trip_parts
from waybill.sources.ranges import read_trips_since, update_ranges

PICKUP = "lpep_pickup_datetime"
SINCE = "2020-01-01"


def month(spark, folder, *pickups, time="timestamp_ntz", **changes):
    trips = trip_rows.raw(spark, *({"pickup": p, **changes} for p in pickups), time=time)
    trips.coalesce(1).write.parquet(folder)


@pytest.fixture
def months(spark, tmp_path):
    """Three old months, of which one holds a stray trip of 2021 and one only NULLs; two new ones."""
    base = f"{tmp_path}/my trips"
    month(spark, f"{base}/year=2018/month=1", datetime(2018, 1, 5), datetime(2018, 1, 9))
    month(spark, f"{base}/year=2018/month=2", datetime(2018, 2, 5), datetime(2021, 3, 1))
    month(spark, f"{base}/year=2018/month=3", None, None)
    month(spark, f"{base}/year=2020/month=1", datetime(2020, 1, 1), datetime(2019, 12, 31, 23, 59))
    month(spark, f"{base}/year=2021/month=1", datetime(2021, 1, 5), datetime(2009, 1, 1))
    return base


def files_read(frame):
    """Files of the scans in a plan, after it ran."""
    execution = frame._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    leaves = execution.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def recent(frame):
    return since(normalize(frame, "green"))


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_fewer_files_and_the_same_trips(spark, months, tmp_path):
    whole = read_trips(spark, months)
    pruned = read_trips_since(spark, months, PICKUP, SINCE, f"{tmp_path}/r")
    assert pruned.schema == whole.schema
    assert rows(recent(pruned)) == rows(recent(whole)) and recent(pruned).count() == 3
    assert files_read(recent(whole)) == 5 and files_read(recent(pruned)) == 3


def test_only_new_and_changed_files_are_looked_at(spark, months, tmp_path):
    folder = f"{tmp_path}/r"
    looks = lambda: len(list((tmp_path / "r" / "_time_ranges").iterdir()))
    known = update_ranges(spark, trip_parts(spark, months), PICKUP, folder)
    assert len(known) == 5 and sum(last is None for last in known.values()) == 1 and looks() == 1
    assert update_ranges(spark, trip_parts(spark, months), PICKUP, folder) == known and looks() == 1
    month(spark, f"{months}/year=2017/month=1", datetime(2022, 1, 1))
    old = trip_rows.raw(spark, *[{"pickup": datetime(2020, 5, i)} for i in range(1, 4)])
    old.coalesce(1).write.mode("overwrite").parquet(f"{months}/year=2018/month=1")
    pruned = read_trips_since(spark, months, PICKUP, SINCE, folder)
    assert looks() == 2 and recent(pruned).count() == 7
    assert rows(recent(pruned)) == rows(recent(read_trips(spark, months)))
    looked = [spark.read.parquet(str(p)).count() for p in (tmp_path / "r" / "_time_ranges").iterdir()]
    assert sorted(looked) == [2, 5]


def test_files_of_different_types(spark, tmp_path):
    base = f"{tmp_path}/two types"
    month(spark, f"{base}/a", datetime(2018, 1, 5), time="timestamp")
    old = trip_rows.raw(spark, {"pickup": datetime(2018, 1, 6)}, time="timestamp")
    old.withColumn("payment_type", F.col("payment_type").cast("double")).coalesce(1).write.parquet(f"{base}/b")
    month(spark, f"{base}/c", datetime(2022, 1, 5), time="timestamp")
    whole = read_trips(spark, f"{base}/*")
    pruned = read_trips_since(spark, f"{base}/*", PICKUP, SINCE, f"{tmp_path}/r")
    assert pruned.schema == whole.schema
    assert rows(recent(pruned)) == rows(recent(whole)) and recent(pruned).count() == 1
    assert files_read(recent(pruned)) < files_read(recent(whole))


@pytest.mark.parametrize("zone", ["Pacific/Kiritimati", "Etc/GMT+12"])
def test_local_times_in_another_zone(spark, tmp_path, zone):
    month(spark, f"{tmp_path}/t/a", datetime(2020, 1, 1, 0, 0), time="timestamp")
    month(spark, f"{tmp_path}/t/b", datetime(2019, 12, 31, 23, 0), time="timestamp")
    update_ranges(spark, trip_parts(spark, f"{tmp_path}/t/*"), PICKUP, f"{tmp_path}/r")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        pruned = read_trips_since(spark, f"{tmp_path}/t/*", PICKUP, SINCE, f"{tmp_path}/r")
        assert rows(recent(pruned)) == rows(recent(read_trips(spark, f"{tmp_path}/t/*")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_no_trip_and_no_such_column(spark, tmp_path):
    month(spark, f"{tmp_path}/t/a", datetime(2018, 1, 5))
    trip_rows.raw(spark, {}).limit(0).write.parquet(f"{tmp_path}/t/b")
    path = f"{tmp_path}/t/*"
    assert recent(read_trips_since(spark, path, PICKUP, SINCE, f"{tmp_path}/r")).count() == 0
    assert read_trips_since(spark, path, "another", SINCE, f"{tmp_path}/r").count() == 1
    assert read_trips_since(spark, path, "payment_type", SINCE, f"{tmp_path}/r").count() == 1


def test_the_job_leaves_out_old_files(spark, months, tmp_path):
    trip_rows.raw(spark, {}, service="yellow").write.parquet(f"{tmp_path}/yellow")
    spark.createDataFrame([(7, "a")], "LocationID int, Zone string").write.parquet(f"{tmp_path}/zones")
    outcomes = []
    for shared in (True, False):
        paths = job.run(
            spark, months, f"{tmp_path}/yellow", f"{tmp_path}/zones", f"{tmp_path}/out{shared}",
            shared_scan=shared, staging=f"{tmp_path}/s",
        )
        outcomes.append([rows(spark.read.parquet(path)) for path in paths.values()])
    assert outcomes[0] == outcomes[1]
    counts = spark.read.parquet(paths["trips_per_service_type"]).collect()
    assert {r.service_type: r.total_trips for r in counts} == {"green": 3, "yellow": 1}
