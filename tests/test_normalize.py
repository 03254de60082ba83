from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import trip_rows
from waybill.operators.attributes import with_calendar, with_era
from waybill.operators.normalize import (
    canonical_trips,
    normalize,
    normalize_all,
    union_common_columns,
    union_trips,
)
from waybill.operators.zones import with_zone
from waybill.schema import TRIP_COLUMNS, SchemaMismatch


def services(spark):
    return {
        "green": trip_rows.raw(spark, {}, service="green").withColumn("ehail_fee", F.lit(1.0)),
        "yellow": trip_rows.raw(spark, {}, {}, service="yellow"),
    }


def test_canonical_columns_and_order(spark):
    trips = canonical_trips(services(spark))
    assert trips.columns == list(TRIP_COLUMNS)
    counts = trips.groupBy("service_type").count().collect()
    assert {row.service_type: row["count"] for row in counts} == {"green": 1, "yellow": 2}


def test_union_keeps_duplicates(spark):
    green = normalize(services(spark)["green"], "green")
    assert union_trips(green, green).count() == 2


def test_missing_column_is_an_error(spark):
    both = services(spark)
    with pytest.raises(AnalysisException):
        normalize(both["green"].drop("tip_amount"), "green")
    green, yellow = (normalize(raw, service) for service, raw in both.items())
    with pytest.raises(AnalysisException):
        union_trips(green, yellow.drop("tip_amount"))


def test_text_in_a_number_column_is_an_error(spark):
    raw = services(spark)["green"].withColumn("RatecodeID", F.lit("1"))
    with pytest.raises(SchemaMismatch, match="RatecodeID: string"):
        normalize(raw, "green")


def test_number_in_a_time_column_is_an_error(spark):
    raw = services(spark)["green"].withColumn("lpep_pickup_datetime", F.lit(1))
    with pytest.raises(SchemaMismatch, match="pickup_datetime: int"):
        normalize(raw, "green")


def test_number_types_widen(spark):
    both = services(spark)
    both["yellow"] = both["yellow"].withColumns(
        {"RatecodeID": F.lit(1.0), "payment_type": F.lit(1).cast("long")}
    )
    types = dict(canonical_trips(both).dtypes)
    assert (types["RatecodeID"], types["payment_type"]) == ("double", "bigint")


def test_union_over_common_columns(spark):
    union = union_common_columns(services(spark))
    assert "ehail_fee" not in union.columns
    assert "lpep_pickup_datetime" not in union.columns
    assert union.columns[-1] == "service_type"
    assert union.count() == 3


def test_common_columns_whatever_their_case(spark):
    both = services(spark)
    both["green"] = both["green"].withColumn("airport_fee", F.lit(1.0))
    both["yellow"] = both["yellow"].withColumn("Airport_fee", F.lit(2.0))
    union = union_common_columns(both)
    assert "airport_fee" in union.columns
    assert sorted(r.airport_fee for r in union.collect()) == [1.0, 2.0, 2.0]


def test_common_columns_of_different_kinds_are_an_error(spark):
    both = services(spark)
    both["yellow"] = both["yellow"].withColumn("payment_type", F.lit("1"))
    with pytest.raises(SchemaMismatch, match="payment_type: int and string"):
        union_common_columns(both)


def test_services_take_the_types_of_their_union(spark):
    raw = {
        "green": trip_rows.raw(spark, {}, service="green", time="timestamp"),
        "yellow": trip_rows.raw(spark, {}, service="yellow").withColumn("RatecodeID", F.lit(1.0)),
    }
    green, yellow = normalize_all(raw).values()
    assert green.dtypes == yellow.dtypes
    assert dict(green.dtypes)["pickup_datetime"] == "timestamp"
    assert dict(green.dtypes)["RatecodeID"] == "double"


def test_calendar(spark):
    row = with_calendar(canonical_trips(services(spark))).first()
    assert (row.hour, row.day_of_week, row.year) == (12, "Wednesday", 2021)
    assert "weekday" not in row.asDict()


def test_day_names_equal_date_format(spark):
    days = spark.sql(
        "SELECT explode(sequence(DATE'1999-12-20', DATE'2000-03-10')) AS d"
    ).select(F.col("d").cast("timestamp_ntz").alias("pickup_datetime"))
    named = with_calendar(days)
    assert named.filter(
        F.col("day_of_week") != F.date_format("pickup_datetime", "EEEE")
    ).isEmpty()


def test_era(spark):
    times = spark.sql(
        "SELECT explode(array(TIMESTAMP_NTZ'2018-12-31 23:59:59', TIMESTAMP_NTZ'2019-01-01 00:00:00',"
        " TIMESTAMP_NTZ'2019-12-31 23:59:59', TIMESTAMP_NTZ'2020-01-01 00:00:00', NULL))"
        " AS pickup_datetime"
    )
    assert [row.era for row in with_era(times).collect()] == [
        "Pre-Congestion",
        "Transition",
        "Transition",
        "Post-Congestion",
        "Post-Congestion",
    ]


def test_zone_lookup(spark):
    zones = spark.createDataFrame(
        [(1, "a"), (2, "b"), (2, "c"), (None, "d")], "LocationID int, Zone string"
    )
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "PULocationID int")
    rows = with_zone(left, zones, "PULocationID").collect()
    found = sorted(((r.PULocationID, r.LocationID, r.Zone) for r in rows), key=str)
    assert found == [(1, 1, "a"), (2, 2, "b"), (2, 2, "c"), (3, None, None), (None, None, None)]
