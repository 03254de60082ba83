"""Column expressions for one trip: duration, speed, plausibility."""

from __future__ import annotations

from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from waybill.functions.rounding import round_half_up
from waybill.rules import DEFAULT_RULES, Rules


def duration_minutes(pickup: Column, dropoff: Column) -> Column:
    """Minutes between two instants, rounded to two decimals.

    Both instants are cut to whole seconds first. A hundredth of a minute is
    0.6 s, so ``seconds * 5 / 3`` ends in 0, 1/3 or 2/3 and never sits on a
    tie: ``rint`` gives the half-up result.
    """
    seconds = F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)
    return F.rint(seconds * 5 / 3) / F.lit(100.0)


def raw_speed(distance: Column, minutes: Column) -> Column:
    """Miles per hour, unrounded; NULL for a trip of zero length in time."""
    return F.try_divide(distance, minutes / 60)


def speed_mph(distance: Column, minutes: Column) -> Column:
    """Miles per hour with two decimals; NULL for a trip of zero length in time."""
    return round_half_up(raw_speed(distance, minutes))


def known_ratecode(ratecode: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """True unless the rate code is the placeholder; NULL codes give NULL."""
    return ratecode != rules.placeholder_ratecode


def plausible(distance: Column, minutes: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Exclusive duration bounds and a cap on the rounded speed.

    There is no lower bound on speed: zero and negative distances pass. The
    cap is tested on the unrounded speed, half a hundredth lower, which accepts
    exactly the same rows and leaves the rounding to the one report that
    shows speeds.
    """
    cap = Decimal(str(rules.max_speed))
    if cap.is_finite():
        cap = cap.quantize(Decimal("0.01"), ROUND_CEILING)
    return (
        (minutes > F.lit(float(rules.min_duration)))
        & (minutes < F.lit(float(rules.max_duration)))
        & (raw_speed(distance, minutes) < F.lit(float(cap - Decimal("0.005"))))
    )
