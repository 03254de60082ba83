from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import trip_rows
from waybill.functions import trip
from waybill.operators.normalize import normalize
from waybill.operators.quality import (
    clean_trips,
    row_counts,
    since,
    valid_trips,
    with_duration,
    with_speed,
)
from waybill.rules import Rules

NOON = trip_rows.NOON


def canonical(spark, *trips, **options):
    return normalize(trip_rows.raw(spark, *trips, **options), "green")


def derived(spark, *trips, **options):
    return with_speed(with_duration(canonical(spark, *trips, **options)))


def test_unknown_payment_types_join_the_default_code(spark):
    trips = canonical(spark, {"payment_type": None}, {"payment_type": 0}, {"payment_type": 2})
    counts = clean_trips(trips).groupBy("payment_type").count().collect()
    assert {row.payment_type: row["count"] for row in counts} == {0: 2, 2: 1}
    assert clean_trips(trips).schema["payment_type"].dataType.simpleString() == "int"


def test_placeholder_and_null_rate_codes_are_dropped(spark):
    trips = canonical(spark, {"RatecodeID": None}, {"RatecodeID": 99}, {"RatecodeID": 6})
    assert [row.RatecodeID for row in clean_trips(trips).collect()] == [6]


@pytest.mark.parametrize(
    ("case", "kept"),
    [
        ({"minutes": 0}, False),
        ({"minutes": -60}, False),
        ({"minutes": 1 / 60, "trip_distance": 0.01}, True),
        ({"minutes": 300}, False),
        ({"minutes": 17999 / 60}, True),
        ({"pickup": None}, False),
        ({"dropoff": None}, False),
        ({"trip_distance": None}, False),
        ({"trip_distance": -5.0}, True),
        ({"trip_distance": 0.0}, True),
        ({"minutes": 60, "trip_distance": 99.996}, False),
        ({"minutes": 60, "trip_distance": 99.995}, False),
        ({"minutes": 60, "trip_distance": 99.9949999}, True),
        ({"minutes": 60, "trip_distance": 99.99}, True),
        ({"trip_distance": float("nan")}, False),
        ({"trip_distance": float("inf")}, False),
        ({"RatecodeID": None}, False),
        ({"RatecodeID": 99}, False),
    ],
)
def test_which_trips_are_valid(spark, case, kept):
    assert valid_trips(clean_trips(canonical(spark, case))).count() == int(kept)


def test_derived_values(spark):
    rows = derived(
        spark,
        {"minutes": 1 / 60},
        {"minutes": 17999 / 60},
        {"minutes": 300},
        {"minutes": -60},
        {"minutes": 10, "trip_distance": -5.0},
        {"minutes": 60, "trip_distance": 99.996},
        {"minutes": 0},
    ).collect()
    assert [r.trip_duration_min for r in rows] == [0.02, 299.98, 300.0, -60.0, 10.0, 60.0, 0.0]
    assert [r.avg_speed_mph for r in rows[4:]] == [-30.0, 100.0, None]


def test_fractions_of_a_second_are_cut_on_each_side(spark):
    pickup = datetime(2021, 1, 1, 0, 0, 0, 900_000)
    dropoff = datetime(2021, 1, 1, 0, 0, 1, 100_000)
    row = derived(spark, {"pickup": pickup, "dropoff": dropoff}).first()
    assert row.trip_duration_min == 0.02


def test_speed_can_be_cached_before_the_filter(spark):
    cached = derived(spark, {"minutes": 0}, {"minutes": 5}).cache()
    assert cached.count() == 2
    assert cached.filter("trip_duration_min > 0 AND avg_speed_mph < 100").count() == 1
    cached.unpersist()


def test_clock_change_counts_wall_time_or_elapsed_time(spark):
    local = (
        "SELECT {t} '2021-03-14 01:30:00' AS p, {t} '2021-03-14 03:30:00' AS d"
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for kind, minutes in (("TIMESTAMP_NTZ", 120.0), ("TIMESTAMP_LTZ", 60.0)):
            row = spark.sql(local.format(t=kind))
            assert row.select(trip.duration_minutes(F.col("p"), F.col("d"))).first()[0] == minutes
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@settings(
    max_examples=20,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=100))
def test_duration_equals_rounded_quotient(spark, seconds):
    pickup = datetime(1990, 1, 1)
    rows = [(pickup, pickup + timedelta(seconds=s), s) for s in seconds]
    frame = spark.createDataFrame(rows, "p timestamp_ntz, d timestamp_ntz, s long")
    fast = trip.duration_minutes(F.col("p"), F.col("d"))
    assert frame.filter(fast != F.round(F.col("s") / 60, 2)).count() == 0


@pytest.mark.parametrize("cap", [100, 55.5, 20.25, 33.333])
def test_cap_on_raw_speed_accepts_what_a_cap_on_rounded_speed_would(spark, cap):
    trips = spark.range(0, 120_000).select(
        (F.col("id") / 1000).alias("distance"), F.lit(60.0).alias("minutes")
    )
    odd = spark.range(0, 60_000).select(
        (F.col("id") % 311 / 7).alias("distance"), (F.col("id") % 97 / 3 + 0.02).alias("minutes")
    )
    distance, minutes = F.col("distance"), F.col("minutes")
    rounded = F.round(F.try_divide(distance, minutes / 60), 2) < cap
    accepted = trip.plausible(distance, minutes, Rules(max_speed=cap))
    for frame in (trips, odd):
        assert frame.filter(accepted != rounded).count() == 0


def test_speed_cap_must_be_positive():
    with pytest.raises(ValueError, match="positive"):
        Rules(max_speed=0)


def test_start_date_is_inclusive_and_open_ended(spark):
    midnight = datetime(2020, 1, 1)
    trips = canonical(
        spark,
        {"pickup": midnight - timedelta(seconds=1)},
        {"pickup": midnight},
        {"pickup": datetime(2098, 1, 1)},
        {"pickup": None},
    )
    kept = [row.pickup_datetime.year for row in since(trips).collect()]
    assert sorted(kept) == [2020, 2098]


def test_row_counts_name_the_services_that_there_are(spark):
    trips = canonical(spark, {}, {})
    other = trips.limit(1).withColumn("service_type", F.lit("blue"))
    counts = {r.relation: r.row_count for r in row_counts(trips.unionByName(other)).collect()}
    assert counts == {"green": 2, "blue": 1, "union": 3}


def test_speed_cap_can_be_switched_off(spark):
    trips = canonical(spark, {"trip_distance": 9000.0}, {"trip_distance": None}, {"minutes": 0})
    rules = Rules(max_speed=float("inf"))
    assert [r.trip_distance for r in valid_trips(trips, rules).collect()] == [9000.0]


def test_other_thresholds(spark):
    rules = Rules(placeholder_ratecode=6, default_payment_type=5, max_duration=20, min_duration=5)
    trips = canonical(
        spark,
        {"RatecodeID": 6},
        {"RatecodeID": 99, "payment_type": None},
        {"minutes": 5},
        {"minutes": 20},
    )
    rows = valid_trips(clean_trips(trips, rules), rules).collect()
    assert [(row.RatecodeID, row.payment_type) for row in rows] == [(99, 5)]
