"""Hand-made trips."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from waybill.schema import TIME_PREFIX

NOON = datetime(2021, 6, 2, 12, 0, 0)  # a Wednesday

RAW_SCHEMA = (
    "{p}pickup_datetime {t}, {p}dropoff_datetime {t}, payment_type int, RatecodeID int,"
    " total_amount double, fare_amount double, tip_amount double, tolls_amount double,"
    " congestion_surcharge double, trip_distance double, PULocationID int, DOLocationID int"
)

DEFAULTS = {
    "pickup": NOON,
    "minutes": 10.0,
    "payment_type": 1,
    "RatecodeID": 1,
    "total_amount": 20.0,
    "fare_amount": 15.0,
    "tip_amount": 3.0,
    "tolls_amount": 0.0,
    "congestion_surcharge": 2.5,
    "trip_distance": 2.0,
    "PULocationID": 7,
    "DOLocationID": 8,
}


def raw(
    spark: SparkSession, *trips: dict, service: str = "green", time: str = "timestamp_ntz"
) -> DataFrame:
    """Raw trips of a service; each dict overrides ``DEFAULTS``.

    ``dropoff`` is taken from ``minutes`` unless it is given.
    """
    rows = []
    for trip in trips:
        row = {**DEFAULTS, **trip}
        minutes = row.pop("minutes")
        pickup = row.pop("pickup")
        if "dropoff" in row:
            dropoff = row.pop("dropoff")
        else:
            dropoff = None if pickup is None else pickup + timedelta(minutes=minutes)
        rows.append((pickup, dropoff, *row.values()))
    return spark.createDataFrame(rows, RAW_SCHEMA.format(p=TIME_PREFIX[service], t=time))
