"""Calendar attributes of a trip."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waybill.rules import DEFAULT_RULES, Rules

# Day names in the order of Spark's ``weekday`` (0 is Monday).
DAY_NAMES = (
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
    "Sunday",
)

# Era labels.
BEFORE, DURING, AFTER = "Pre-Congestion", "Transition", "Post-Congestion"


def day_name(weekday: Column) -> Column:
    """English day name of a weekday number; cheaper than formatting each date."""
    return F.element_at(F.array(*map(F.lit, DAY_NAMES)), weekday + 1)


def era(year: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Surcharge era of a year; an unknown year falls into the last one."""
    turn = rules.transition_year
    return F.when(year < turn, BEFORE).when(year == turn, DURING).otherwise(AFTER)
