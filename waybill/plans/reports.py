"""The ten reports, declared once and computed from trips.

``build`` takes a report straight from trips and reads only the columns that
the report needs. ``waybill.plans.summary`` computes the same reports from one
shared scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions import calendar
from waybill.functions.exact import with_parts
from waybill.operators.attributes import with_keys
from waybill.operators.quality import valid_trips
from waybill.operators.zones import with_zone
from waybill.plans.metrics import Mean, Rows, Total, trip_totals, with_metrics
from waybill.rules import DEFAULT_RULES, Rules

TRIPS_VIEW = "trips"

# Fixed values below: names of reports, metrics and columns, and the orders.

RECENT = "recent"  # clean trips from the start date on
CLEAN = "clean"  # clean trips
VALID = "valid"  # clean trips of plausible duration and speed


@dataclass(frozen=True)
class Report:
    name: str
    scope: str
    by: tuple[str, ...]
    metrics: tuple[Rows | Total | Mean, ...]
    order: tuple[str, ...] = ()
    descending: bool = False
    zone_key: str | None = None

    @property
    def measures(self) -> tuple[str, ...]:
        return tuple(m.measure for m in self.metrics if not isinstance(m, Rows))


TRIPS_PER_SERVICE = Report(
    "trips_per_service_type",
    RECENT,
    by=("service_type",),
    metrics=(Rows("total_trips"),),
)
FARES = Report(
    "fare_analysis",
    CLEAN,
    by=("service_type", "payment_type"),
    metrics=(
        Total("total_revenue_k", "total_amount", per=1000),
        Mean("avg_fare", "fare_amount"),
        Mean("avg_tip", "tip_amount"),
        Mean("avg_tolls", "tolls_amount"),
        Mean("avg_congestion", "congestion_surcharge"),
        Rows("total_trips"),
    ),
    order=("service_type", "payment_type"),
)
YEARLY_VOLUME = Report(
    "yoy_trip_volume",
    CLEAN,
    by=("year", "service_type"),
    metrics=(
        Rows("total_trips"),
        Total("total_revenue", "total_amount"),
        Mean("avg_distance", "trip_distance"),
    ),
    order=("year",),
)
SPEED_BY_ZONE = Report(
    "speed_by_zone",
    VALID,
    by=("PULocationID",),
    metrics=(
        Mean("avg_speed", "avg_speed_mph"),
        Mean("avg_duration", "trip_duration_min"),
        Rows("trip_count"),
    ),
    order=("avg_speed",),
)
TOP_PICKUP = Report(
    "top_pickup_zones",
    VALID,
    by=("PULocationID",),
    metrics=(
        Rows("pickup_count"),
        Mean("avg_revenue_per_trip", "total_amount"),
    ),
    order=("pickup_count",),
    descending=True,
    zone_key="PULocationID",
)
TOP_DROPOFF = Report(
    "top_dropoff_zones",
    VALID,
    by=("DOLocationID",),
    metrics=(
        Rows("dropoff_count"),
        Total("total_revenue", "total_amount"),
    ),
    order=("total_revenue",),
    descending=True,
    zone_key="DOLocationID",
)
PAYMENT_BEHAVIOR = Report(
    "payment_behavior",
    VALID,
    by=("payment_type", "service_type"),
    metrics=(
        Rows("trip_count"),
        Mean("avg_tip", "tip_amount"),
        Mean("avg_total", "total_amount"),
        Mean("avg_distance", "trip_distance"),
    ),
    order=("payment_type",),
)
HOURLY_PATTERNS = Report(
    "hourly_patterns",
    VALID,
    by=("hour", "weekday"),
    metrics=(
        Rows("trip_count"),
        Mean("avg_revenue", "total_amount"),
        Mean("avg_tip", "tip_amount"),
    ),
    order=("day_of_week", "hour"),
)
RATECODES = Report(
    "ratecode_analysis",
    VALID,
    by=("RatecodeID",),
    metrics=(
        Rows("trip_count"),
        Mean("avg_fare", "fare_amount"),
        Mean("avg_distance", "trip_distance"),
        Mean("avg_tip", "tip_amount"),
        Total("total_revenue_k", "total_amount", per=1000),
    ),
    order=("RatecodeID",),
)
CONGESTION = Report(
    "congestion_impact",
    VALID,
    by=("era", "service_type"),
    metrics=(
        Rows("trip_count"),
        Mean("avg_total", "total_amount"),
        Mean("avg_fare", "fare_amount"),
        Mean("avg_congestion_charge", "congestion_surcharge"),
    ),
    order=("era",),
)

REPORTS = (
    TRIPS_PER_SERVICE,
    FARES,
    YEARLY_VOLUME,
    SPEED_BY_ZONE,
    TOP_PICKUP,
    TOP_DROPOFF,
    PAYMENT_BEHAVIOR,
    HOURLY_PATTERNS,
    RATECODES,
    CONGESTION,
)


def register_trips(clean: DataFrame) -> None:
    """Make clean trips available to SQL, replacing an earlier registration."""
    clean.createOrReplaceTempView(TRIPS_VIEW)


def trips_per_service(trips: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The first report, as SQL over clean trips; leaves the session's views alone."""
    return trips.sparkSession.sql(
        "SELECT service_type, count(*) AS total_trips FROM {trips}"
        " WHERE pickup_datetime >= :since GROUP BY service_type",
        args={"since": rules.since},
        trips=trips,
    )


def finish(report: Report, groups: DataFrame, zones: DataFrame | None) -> DataFrame:
    """Name days, look up zones, then sort; ties follow the grouping keys.

    Days are grouped by number and named here, over the groups only.
    """
    keys = ["day_of_week" if key == "weekday" else key for key in report.by]
    if "weekday" in report.by:
        groups = groups.withColumn("day_of_week", calendar.day_name(F.col("weekday")))
    groups = groups.select(*keys, *(metric.name for metric in report.metrics))
    if report.zone_key:
        groups = with_zone(groups, zones, report.zone_key)
    if not report.order:
        return groups
    ranked = [F.desc(c) if report.descending else F.asc(c) for c in report.order]
    return groups.orderBy(*ranked, *(key for key in keys if key not in report.order))


def build(
    report: Report,
    clean: DataFrame,
    zones: DataFrame | None = None,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Compute a report from clean trips."""
    if report.scope == RECENT:
        return trips_per_service(clean, rules)
    trips = valid_trips(clean, rules) if report.scope == VALID else clean
    parts = with_parts(with_keys(trips, report.by, rules), report.measures)
    totals = trip_totals(parts, report.by, report.measures)
    return finish(report, with_metrics(totals, report.by, report.metrics), zones)
