"""Cleaning and plausibility of canonical trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions import trip
from waybill.rules import DEFAULT_RULES, Rules
from waybill.schema import SERVICE


def fill_payment_type(trips: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Merge unknown payment types into the default code."""
    filled = F.coalesce("payment_type", F.lit(rules.default_payment_type))
    return trips.withColumn("payment_type", filled)


def clean_trips(trips: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Fill payment types; drop trips whose rate code is a placeholder or NULL."""
    return fill_payment_type(trips, rules).filter(
        trip.known_ratecode(F.col("RatecodeID"), rules)
    )


def since(trips: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Trips picked up on or after the start date, which reaches the Parquet scan."""
    return trips.filter(F.col("pickup_datetime") >= start_of(trips, rules))


def start_of(trips: DataFrame, rules: Rules = DEFAULT_RULES):
    """The start date as a literal of the type of the pick-up column."""
    return F.lit(rules.since).cast(trips.schema["pickup_datetime"].dataType)


def with_duration(trips: DataFrame) -> DataFrame:
    minutes = trip.duration_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return trips.withColumn("trip_duration_min", minutes)


def with_speed(trips: DataFrame) -> DataFrame:
    """Adds ``avg_speed_mph``; needs ``trip_duration_min``."""
    speed = trip.speed_mph(F.col("trip_distance"), F.col("trip_duration_min"))
    return trips.withColumn("avg_speed_mph", speed)


def valid_trips(clean: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Clean trips with duration and speed added, implausible ones dropped."""
    derived = with_speed(with_duration(clean))
    return derived.filter(
        trip.plausible(F.col("trip_distance"), F.col("trip_duration_min"), rules)
    )


def row_counts(trips: DataFrame) -> DataFrame:
    """Rows per service and, as relation ``union``, in all; reads no trip column.

    A service without a trip has no row.
    """
    counts = trips.rollup(SERVICE).agg(
        F.grouping(SERVICE).alias("in_all"), F.count("*").alias("row_count")
    )
    relation = F.when(F.col("in_all") == 1, F.lit("union")).otherwise(F.col(SERVICE))
    return counts.select(relation.alias("relation"), "row_count")
