"""ANSI SQL that states, independently of the Spark code, what each query returns."""

from __future__ import annotations

import re

_HALF_UP = re.compile(r"half_up\((sum|avg)\((\w+)\)(?: / (\d+))?, 2\)")

# The measures of the reports.
_MEASURES = (
    "total_amount",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "congestion_surcharge",
    "trip_distance",
    "avg_speed_mph",
    "trip_duration_min",
)


def _decimal(measure: str) -> str:
    """An amount as its own decimal text says, to the 18th place."""
    return f"CAST(CAST({measure} AS VARCHAR) AS DECIMAL(38, 18))"


_MEASURE_SUMS = ", ".join(
    f"sum({_decimal(m)}) AS {m}, count({m}) AS {m}_n" for m in _MEASURES
)
_MEASURES_SHOWN = ", ".join(
    f"CAST(round({m}, 9) AS DOUBLE) AS {m}, {m}_n" for m in _MEASURES
)

_RELATIONS = """
WITH shipped AS (
  SELECT *,
    l_shipdate + INTERVAL '22' YEAR
      + INTERVAL '1' SECOND * CAST((l_orderkey * 7919 + l_linenumber * 104729) % 86400 AS INT)
      AS pickup_at
  FROM lineitem
),
raw_trips AS (
  SELECT
    CASE l_linestatus WHEN 'F' THEN 'green' WHEN 'O' THEN 'yellow' END AS service_type,
    pickup_at AS pickup_datetime,
    pickup_at + INTERVAL '1' SECOND * CAST(
      CASE WHEN l_partkey % 50 = 7 THEN 0
           ELSE (l_partkey * 37 + l_orderkey * 11) % 20000 - 600 END AS INT)
      AS dropoff_datetime,
    CASE WHEN l_linenumber < 7 THEN l_linenumber - 1 END AS payment_type,
    CASE WHEN l_quantity >= 49 THEN 99
         WHEN l_quantity < 47 THEN CAST(l_quantity AS INT) % 6 + 1 END AS "RatecodeID",
    l_extendedprice AS total_amount,
    l_quantity AS fare_amount,
    l_discount * 100 AS tip_amount,
    l_tax * 100 AS tolls_amount,
    CASE WHEN l_shipdate >= TIMESTAMP '1997-02-01 00:00:00'
         THEN CAST(2.5 * (l_linenumber % 2) AS DOUBLE) END AS congestion_surcharge,
    CASE WHEN l_partkey % 50 <> 0 THEN l_quantity - 2 END AS trip_distance,
    CAST(l_suppkey AS INT) AS "PULocationID",
    CAST(l_partkey % 265 AS INT) AS "DOLocationID"
  FROM shipped
),
trips AS (SELECT * FROM raw_trips WHERE service_type IS NOT NULL),
zones AS (
  SELECT CAST(s_suppkey + CASE WHEN s_suppkey % 10 = 3 THEN 1000000 ELSE 0 END AS INT)
           AS "LocationID", r_name AS "Borough",
         s_name AS "Zone", n_name AS service_zone
  FROM supplier
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
clean AS (
  SELECT * REPLACE (coalesce(payment_type, 0) AS payment_type)
  FROM trips WHERE "RatecodeID" <> 99
),
timed AS (
  SELECT *, round((epoch_us(dropoff_datetime) // 1000000
                   - epoch_us(pickup_datetime) // 1000000) / 60, 2) AS trip_duration_min
  FROM clean
),
moving AS (
  SELECT *, round(trip_distance / nullif(trip_duration_min / 60, 0), 2) AS avg_speed_mph
  FROM timed
),
valid AS (
  SELECT * FROM moving
  WHERE trip_duration_min > 0 AND trip_duration_min < 300 AND avg_speed_mph < 100
)
"""

_CANONICAL = """pickup_datetime, dropoff_datetime, payment_type, "RatecodeID", total_amount,
  fare_amount, tip_amount, tolls_amount, congestion_surcharge, trip_distance,
  "PULocationID", "DOLocationID", service_type"""

_SHARED = """payment_type, "RatecodeID", total_amount, fare_amount, tip_amount, tolls_amount,
  congestion_surcharge, trip_distance, "PULocationID", "DOLocationID" """

_ERA = """CASE WHEN year(pickup_datetime) < 2019 THEN 'Pre-Congestion'
  WHEN year(pickup_datetime) = 2019 THEN 'Transition' ELSE 'Post-Congestion' END"""


def _scan(service: str, prefix: str) -> str:
    return f"""SELECT pickup_datetime AS {prefix}pickup_datetime,
  dropoff_datetime AS {prefix}dropoff_datetime, {_SHARED}
FROM trips WHERE service_type = '{service}'"""


_FARES = """SELECT service_type, payment_type,
  half_up(sum(total_amount) / 1000, 2) AS total_revenue_k,
  half_up(avg(fare_amount), 2) AS avg_fare, half_up(avg(tip_amount), 2) AS avg_tip,
  half_up(avg(tolls_amount), 2) AS avg_tolls,
  half_up(avg(congestion_surcharge), 2) AS avg_congestion, count(*) AS total_trips
FROM clean GROUP BY service_type, payment_type ORDER BY service_type, payment_type"""

REPORTS = {
    "r01_trips_per_service": """SELECT service_type, count(*) AS total_trips FROM clean
WHERE pickup_datetime >= TIMESTAMP '2020-01-01 00:00:00' GROUP BY service_type""",
    "r02_fare_analysis": _FARES,
    "r03_yoy_volume": """SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, service_type,
  count(*) AS total_trips, half_up(sum(total_amount), 2) AS total_revenue,
  half_up(avg(trip_distance), 2) AS avg_distance
FROM clean GROUP BY 1, 2 ORDER BY 1, 2""",
    "r04_speed_by_zone": """SELECT "PULocationID",
  half_up(avg(avg_speed_mph), 2) AS avg_speed,
  half_up(avg(trip_duration_min), 2) AS avg_duration, count(*) AS trip_count
FROM valid GROUP BY "PULocationID" ORDER BY avg_speed NULLS FIRST, "PULocationID" """,
    "r05_top_pickup": """SELECT t.*, z.* FROM (
  SELECT "PULocationID", count(*) AS pickup_count,
    half_up(avg(total_amount), 2) AS avg_revenue_per_trip
  FROM valid GROUP BY "PULocationID") t
LEFT JOIN zones z ON t."PULocationID" = z."LocationID"
ORDER BY pickup_count DESC, "PULocationID" """,
    "r06_top_dropoff": """SELECT t.*, z.* FROM (
  SELECT "DOLocationID", count(*) AS dropoff_count, half_up(sum(total_amount), 2) AS total_revenue
  FROM valid GROUP BY "DOLocationID") t
LEFT JOIN zones z ON t."DOLocationID" = z."LocationID"
ORDER BY total_revenue DESC, "DOLocationID" """,
    "r07_payment_behavior": """SELECT payment_type, service_type, count(*) AS trip_count,
  half_up(avg(tip_amount), 2) AS avg_tip, half_up(avg(total_amount), 2) AS avg_total,
  half_up(avg(trip_distance), 2) AS avg_distance
FROM valid GROUP BY payment_type, service_type ORDER BY payment_type, service_type""",
    "r08_hourly_patterns": """SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour,
  dayname(pickup_datetime) AS day_of_week, count(*) AS trip_count,
  half_up(avg(total_amount), 2) AS avg_revenue, half_up(avg(tip_amount), 2) AS avg_tip
FROM valid GROUP BY 1, 2 ORDER BY 2, 1""",
    "r09_ratecode": """SELECT "RatecodeID", count(*) AS trip_count,
  half_up(avg(fare_amount), 2) AS avg_fare, half_up(avg(trip_distance), 2) AS avg_distance,
  half_up(avg(tip_amount), 2) AS avg_tip, half_up(sum(total_amount) / 1000, 2) AS total_revenue_k
FROM valid GROUP BY "RatecodeID" ORDER BY "RatecodeID" """,
    "r10_congestion": f"""SELECT {_ERA} AS era, service_type, count(*) AS trip_count,
  half_up(avg(total_amount), 2) AS avg_total, half_up(avg(fare_amount), 2) AS avg_fare,
  half_up(avg(congestion_surcharge), 2) AS avg_congestion_charge
FROM valid GROUP BY 1, 2 ORDER BY 1, 2""",
}

OPERATORS = {
    "scan_green": _scan("green", "lpep_"),
    "scan_yellow": _scan("yellow", "tpep_"),
    "scan_zones": "SELECT * FROM zones",
    "row_counts": """SELECT service_type AS relation, count(*) AS row_count
FROM trips GROUP BY service_type
UNION ALL SELECT 'union', count(*) FROM trips""",
    "sink_roundtrip": _FARES,
    "normalize_green": f"SELECT {_CANONICAL} FROM trips WHERE service_type = 'green'",
    "normalize_yellow": f"SELECT {_CANONICAL} FROM trips WHERE service_type = 'yellow'",
    "union_trips": f"SELECT {_CANONICAL} FROM trips",
    "union_common_columns": f"SELECT {_SHARED}, service_type FROM trips",
    "clean_trips": f"SELECT {_CANONICAL} FROM clean",
    "filter_since": f"""SELECT {_CANONICAL} FROM clean
WHERE pickup_datetime >= TIMESTAMP '2020-01-01 00:00:00'""",
    "trip_duration": "SELECT pickup_datetime, dropoff_datetime, trip_duration_min FROM timed",
    "trip_speed": "SELECT trip_distance, trip_duration_min, avg_speed_mph FROM moving",
    "valid_trips": f"SELECT {_CANONICAL}, trip_duration_min, avg_speed_mph FROM valid",
    "calendar_columns": """SELECT pickup_datetime, CAST(hour(pickup_datetime) AS INTEGER) AS hour,
  dayname(pickup_datetime) AS day_of_week, CAST(year(pickup_datetime) AS INTEGER) AS year
FROM valid""",
    "era_bucket": f"SELECT pickup_datetime, {_ERA} AS era FROM valid",
    "zone_join_pickup": """SELECT t.*, z.* FROM (SELECT DISTINCT "PULocationID" FROM valid) t
LEFT JOIN zones z ON t."PULocationID" = z."LocationID" """,
    "zone_join_dropoff": """SELECT t.*, z.* FROM (SELECT DISTINCT "DOLocationID" FROM valid) t
LEFT JOIN zones z ON t."DOLocationID" = z."LocationID" """,
    "round_half_up": """SELECT l_orderkey, l_linenumber,
  round(l_extendedprice / 7, 2) AS rounded FROM lineitem""",
    "trip_summary": f""", timed_raw AS (
  SELECT *, round((epoch_us(dropoff_datetime) // 1000000
                   - epoch_us(pickup_datetime) // 1000000) / 60, 2) AS trip_duration_min
  FROM trips
), keyed AS (
  SELECT service_type, coalesce(payment_type, 0) AS payment_type, "RatecodeID",
    CAST(year(pickup_datetime) AS INTEGER) AS year,
    pickup_datetime >= TIMESTAMP '2020-01-01 00:00:00' AS recent,
    "PULocationID", "DOLocationID",
    CAST(hour(pickup_datetime) AS INTEGER) AS hour,
    CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS weekday,
    round(trip_distance / nullif(trip_duration_min / 60, 0), 2) AS avg_speed_mph,
    coalesce("RatecodeID" <> 99 AND trip_duration_min > 0 AND trip_duration_min < 300
      AND round(trip_distance / nullif(trip_duration_min / 60, 0), 2) < 100, FALSE) AS valid,
    total_amount, fare_amount, tip_amount, tolls_amount, congestion_surcharge, trip_distance,
    trip_duration_min
  FROM timed_raw
), grouped AS (
  SELECT service_type, valid, payment_type, "RatecodeID", year, recent, "PULocationID",
    "DOLocationID", hour, weekday,
    CASE WHEN grouping(payment_type) = 0 THEN 'codes'
         WHEN grouping("PULocationID") = 0 THEN 'pickup'
         WHEN grouping("DOLocationID") = 0 THEN 'dropoff' ELSE 'clock' END AS slice,
    count(*) AS trip_rows, {_MEASURE_SUMS}
  FROM keyed GROUP BY GROUPING SETS (
    (service_type, valid, payment_type, "RatecodeID", year, recent),
    (service_type, valid, "PULocationID"), (service_type, valid, "DOLocationID"),
    (service_type, valid, hour, weekday))
)
SELECT service_type, valid, payment_type, "RatecodeID", year, recent, "PULocationID",
  "DOLocationID", hour, weekday, slice, trip_rows, {_MEASURES_SHOWN}
FROM grouped""",
}


def _exact(match: re.Match) -> str:
    """Half-up rounding of an exact total or mean, in whole numbers only.

    ROUND on a DOUBLE works on its binary value there and takes 14.215 for a
    little less, so amounts are added as decimals of 18 places and the total is
    rounded as an integer of units of 10^-18.
    """
    aggregate, measure, per = match.groups()
    total = f"CAST(replace(CAST(sum({_decimal(measure)}) AS VARCHAR), '.', '') AS HUGEINT)"
    parts = f"count({measure})" if aggregate == "avg" else (per or "1")
    # Half a hundredth of the whole is this many units for each row that shares it.
    unit = f"({parts} * CAST(5000000000000000 AS HUGEINT))"
    return f"CAST(sign({total}) * ((abs({total}) // {unit} + 1) // 2) AS DOUBLE) / 100"


def _spell_out(sql: str) -> str:
    """Replace half_up(sum(x), 2), half_up(sum(x) / n, 2) and half_up(avg(x), 2)."""
    return _HALF_UP.sub(_exact, sql)


# Report directory, grouping keys and metrics of each report.
_WRITTEN = {
    "r01_trips_per_service": ("trips_per_service_type", ("service_type",), ("total_trips",)),
    "r02_fare_analysis": (
        "fare_analysis",
        ("service_type", "payment_type"),
        ("total_revenue_k", "avg_fare", "avg_tip", "avg_tolls", "avg_congestion", "total_trips"),
    ),
    "r03_yoy_volume": (
        "yoy_trip_volume",
        ("year", "service_type"),
        ("total_trips", "total_revenue", "avg_distance"),
    ),
    "r04_speed_by_zone": (
        "speed_by_zone",
        ("PULocationID",),
        ("avg_speed", "avg_duration", "trip_count"),
    ),
    "r05_top_pickup": (
        "top_pickup_zones",
        ("PULocationID",),
        ("pickup_count", "avg_revenue_per_trip"),
    ),
    "r06_top_dropoff": (
        "top_dropoff_zones",
        ("DOLocationID",),
        ("dropoff_count", "total_revenue"),
    ),
    "r07_payment_behavior": (
        "payment_behavior",
        ("payment_type", "service_type"),
        ("trip_count", "avg_tip", "avg_total", "avg_distance"),
    ),
    "r08_hourly_patterns": (
        "hourly_patterns",
        ("hour", "day_of_week"),
        ("trip_count", "avg_revenue", "avg_tip"),
    ),
    "r09_ratecode": (
        "ratecode_analysis",
        ("RatecodeID",),
        ("trip_count", "avg_fare", "avg_distance", "avg_tip", "total_revenue_k"),
    ),
    "r10_congestion": (
        "congestion_impact",
        ("era", "service_type"),
        ("trip_count", "avg_total", "avg_fare", "avg_congestion_charge"),
    ),
}


def _job_reports() -> str:
    """All reports in long form: one row per group and metric."""
    tables, rows = [], []
    for key, (name, keys, metrics) in _WRITTEN.items():
        tables.append(f", {key} AS ({REPORTS[key]})")
        item = " || '|' || ".join(f"""coalesce(CAST("{k}" AS VARCHAR), '-')""" for k in keys)
        rows += [
            f"SELECT '{name}' AS report, {item} AS item, '{metric}' AS metric,"
            f' CAST("{metric}" AS DOUBLE) AS value FROM {key}'
            for metric in metrics
        ]
    return "\n".join(tables) + "\n" + "\nUNION ALL ".join(rows)


def statements() -> dict[str, str]:
    shared = {f"shared_{name}": sql for name, sql in REPORTS.items()}
    written = {"job_reports": _job_reports(), "job_mixed_types": _job_reports()}
    pruned = {"filter_since_files": OPERATORS["filter_since"]}
    every = {**OPERATORS, **pruned, **written, **REPORTS, **shared}
    return {name: _RELATIONS + _spell_out(sql) for name, sql in every.items()}
