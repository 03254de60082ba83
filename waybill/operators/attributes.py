"""Calendar attributes as columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions import calendar
from waybill.rules import DEFAULT_RULES, Rules


def with_calendar(trips: DataFrame) -> DataFrame:
    """Adds ``hour``, ``day_of_week`` and ``year`` of the pick-up."""
    named = with_keys(trips, ("hour", "weekday", "year"))
    return named.withColumn("day_of_week", calendar.day_name(F.col("weekday"))).drop("weekday")


def with_era(trips: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Adds the surcharge ``era`` of the pick-up."""
    return with_keys(trips, ("era",), rules).drop("year")


def with_keys(
    trips: DataFrame, keys: Iterable[str], rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Adds those of ``year``, ``hour``, ``weekday`` and ``era`` that are asked for.

    The era is derived from the ``year`` column, so that the year of a trip is
    computed once.
    """
    pickup = F.col("pickup_datetime")
    derived = {"hour": F.hour(pickup), "weekday": F.weekday(pickup), "year": F.year(pickup)}
    needed = {"year" if key == "era" else key for key in keys}
    for name in derived:
        if name in needed:
            trips = trips.withColumn(name, derived[name])
    if "era" in keys:
        trips = trips.withColumn("era", calendar.era(F.col("year"), rules))
    return trips
