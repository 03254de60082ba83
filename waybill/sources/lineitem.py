"""Trips and zones derived from the TPC-H-like test tables.

Order lines become trips (finished lines green, open ones yellow) and
suppliers become zones. The shift of 22 years puts pick-ups on both sides of
the dates the reports care about, and some codes, distances and durations are
made NULL, zero or implausible on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.schema import TIME_PREFIX

_LINE_STATUS = {"green": "F", "yellow": "O"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seconds(amount: Column) -> Column:
    return F.expr("INTERVAL '1' SECOND") * amount.cast("int")


def services(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw trips of every service."""
    lines = _table(spark, sf_dir, "lineitem")
    return {service: _trips_of(lines, service) for service in _LINE_STATUS}


def trips(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """Raw trips of one service, with that service's column names."""
    return _trips_of(_table(spark, sf_dir, "lineitem"), service)


def _trips_of(lines: DataFrame, service: str) -> DataFrame:
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    quantity, shipped = F.col("l_quantity"), F.col("l_shipdate")
    prefix = TIME_PREFIX[service]

    of_day = (order * 7919 + line * 104729) % 86400
    travel = F.when(part % 50 == 7, F.lit(0)).otherwise((part * 37 + order * 11) % 20000 - 600)
    day = shipped + F.expr("INTERVAL '22' YEAR")
    surcharged = shipped >= F.lit("1997-02-01").cast("timestamp_ntz")

    return lines.filter(F.col("l_linestatus") == _LINE_STATUS[service]).select(
        (day + _seconds(of_day)).alias(f"{prefix}pickup_datetime"),
        (day + _seconds(of_day + travel)).alias(f"{prefix}dropoff_datetime"),
        F.when(line < 7, line - 1).alias("payment_type"),
        F.when(quantity >= 49, F.lit(99))
        .when(quantity < 47, quantity.cast("int") % 6 + 1)
        .alias("RatecodeID"),
        F.col("l_extendedprice").alias("total_amount"),
        quantity.alias("fare_amount"),
        (F.col("l_discount") * 100).alias("tip_amount"),
        (F.col("l_tax") * 100).alias("tolls_amount"),
        F.when(surcharged, F.lit(2.5) * (line % 2)).alias("congestion_surcharge"),
        F.when(part % 50 != 0, quantity - 2).alias("trip_distance"),
        F.col("l_suppkey").cast("int").alias("PULocationID"),
        (part % 265).cast("int").alias("DOLocationID"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup; a tenth of the zones has another number, so that some trips' are unknown."""
    suppliers = _table(spark, sf_dir, "supplier")
    moved = F.when(F.col("s_suppkey") % 10 == 3, F.lit(1_000_000)).otherwise(0)
    nations, regions = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    return (
        suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (F.col("s_suppkey") + moved).cast("int").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("s_name").alias("Zone"),
            F.col("n_name").alias("service_zone"),
        )
    )
