"""Random trips full of edge values against a plain Python computation."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest

import trip_rows
from waybill.operators.normalize import canonical_trips, normalize_all
from waybill.operators.quality import clean_trips
from waybill.plans import reports, summary

DAYS = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()


def random_trips(seed: int, n: int) -> list[dict]:
    rng = random.Random(seed)

    def cents(low: int, high: int) -> float | None:
        return None if rng.random() < 0.1 else rng.randint(low, high) / 100

    trips = []
    for _ in range(n):
        year = rng.choice([2009, 2018, 2019, 2020, 2021])
        pickup = datetime(year, 1, 1) + timedelta(seconds=rng.randint(-5, 31_535_999))
        seconds = rng.choice([0, 1, 17_999, 18_000, -60, 36, 600, 3600, rng.randint(1, 20_000)])
        dropoff = pickup + timedelta(seconds=seconds, microseconds=rng.choice([0, 0, 999_999]))
        trips.append(
            {
                "pickup": rng.choice([pickup] * 9 + [None]),
                "dropoff": rng.choice([dropoff] * 9 + [None]),
                "payment_type": rng.choice([None, 0, 1, 2]),
                "RatecodeID": rng.choice([None, 99, 1, 2, 6]),
                "total_amount": cents(-500, 9000),
                "fare_amount": cents(-500, 9000),
                "tip_amount": cents(0, 900),
                "tolls_amount": cents(0, 900),
                "congestion_surcharge": rng.choice([None, 0.0, 2.5]),
                "trip_distance": rng.choice([0.0, -5.0, 99.995, 99.99, cents(1, 3000)]),
                "PULocationID": rng.choice([132] * 5 + [None, 1, 2, 3]),
                "DOLocationID": rng.choice([None, 1, 2, 3]),
            }
        )
    return trips


def rounded(value: Fraction | float | None) -> float | None:
    if value is None:
        return None
    if isinstance(value, float):
        exact = Decimal(repr(value))
    else:
        exact = Decimal(value.numerator) / Decimal(value.denominator)
    return float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP)) + 0.0


def derive(trip: dict, service: str) -> dict | None:
    """The clean trip with its derived values, or None if cleaning drops it."""
    if trip["RatecodeID"] in (None, 99):
        return None
    pickup, dropoff, distance = trip["pickup"], trip["dropoff"], trip["trip_distance"]
    minutes = speed = None
    if pickup is not None and dropoff is not None:
        whole = dropoff.replace(microsecond=0) - pickup.replace(microsecond=0)
        minutes = rounded(Fraction(int(whole.total_seconds()), 60))
        if distance is not None and minutes != 0:
            speed = rounded(distance / (minutes / 60))
    year = None if pickup is None else pickup.year
    return {
        **trip,
        "service_type": service,
        "payment_type": trip["payment_type"] or 0,
        "trip_duration_min": minutes,
        "avg_speed_mph": speed,
        "recent": pickup is not None and pickup >= datetime(2020, 1, 1),
        "valid": minutes is not None and 0 < minutes < 300 and speed is not None and speed < 100,
        "clean": True,
        "year": year,
        "hour": None if pickup is None else pickup.hour,
        "weekday": None if pickup is None else DAYS[pickup.weekday()],
        "era": "Pre-Congestion"
        if year is not None and year < 2019
        else ("Transition" if year == 2019 else "Post-Congestion"),
    }


def expected(report: reports.Report, trips: list[dict]) -> dict[tuple, tuple]:
    groups = defaultdict(list)
    for trip in trips:
        if trip[report.scope]:
            groups[tuple(trip[key] for key in report.by)].append(trip)

    def value(metric, members):
        if isinstance(metric, reports.Rows):
            return len(members)
        known = [Fraction(repr(t[metric.measure])) for t in members if t[metric.measure] is not None]
        if not known:
            return None
        if isinstance(metric, reports.Total):
            return rounded(sum(known) / metric.per)
        return rounded(sum(known) / len(known))

    return {
        key: tuple(value(metric, members) for metric in report.metrics)
        for key, members in groups.items()
    }


@pytest.fixture(scope="module")
def random_services(spark):
    trips = {"green": random_trips(1, 900), "yellow": random_trips(2, 1500)}
    raw = {s: trip_rows.raw(spark, *rows, service=s).cache() for s, rows in trips.items()}
    clean = [derive(trip, service) for service, rows in trips.items() for trip in rows]
    yield raw, [trip for trip in clean if trip is not None]
    for frame in raw.values():
        frame.unpersist()


@pytest.mark.parametrize("report", reports.REPORTS, ids=lambda r: r.name)
def test_reports_equal_brute_force(spark, random_services, report):
    raw, clean = random_services
    zones = spark.createDataFrame([(132, "Airport")], "LocationID int, Zone string")
    totals = summary.summarize(normalize_all(raw))
    want = expected(report, clean)
    assert len(want) > 1
    for frame in (
        reports.build(report, clean_trips(canonical_trips(raw)), zones),
        summary.report_from_summary(report, totals, zones),
    ):
        keys = ["day_of_week" if key == "weekday" else key for key in report.by]
        got = {
            tuple(row[key] for key in keys): tuple(row[m.name] for m in report.metrics)
            for row in frame.collect()
        }
        assert got == want


def test_valid_trips_exist_in_every_slice(random_services):
    _, clean = random_services
    assert 100 < sum(trip["valid"] for trip in clean) < len(clean)
