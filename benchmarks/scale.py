"""Compares ways of computing the ten reports on enlarged test tables.

    python benchmarks/scale.py COPIES FOLDER

writes COPIES shifted copies of the order lines as trips (a third of them in
one pick-up zone) below FOLDER once, and prints seconds per variant. UI off,
best of two runs, results collected; all variants must give the same reports.
"""

from __future__ import annotations

import os
import sys
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from waybill.functions.exact import with_parts  # noqa: E402
from waybill.operators.attributes import with_keys  # noqa: E402
from waybill.operators.normalize import canonical_trips, normalize_all  # noqa: E402
from waybill.operators.quality import clean_trips, valid_trips  # noqa: E402
from waybill.plans import reports, summary  # noqa: E402
from waybill.plans.metrics import trip_totals, with_metrics  # noqa: E402
from waybill.schema import TIME_PREFIX  # noqa: E402
from waybill.sources import lineitem  # noqa: E402
from waybill.sources.parquet import read_trips, read_zones  # noqa: E402

Results = list[list]

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def write_inputs(spark: SparkSession, copies: int, folder: str) -> None:
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    hot = F.when(F.rand(7) < 0.33, 132).otherwise(F.col("l_suppkey") % 265)
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    lines.repartition(16).withColumn("id", copy).withColumns(
        {
            "l_orderkey": F.col("l_orderkey") + F.col("id") * 1000003,
            "l_partkey": F.col("l_partkey") + F.col("id") * 31,
            "l_suppkey": hot.cast("long"),
        }
    ).drop("id").write.parquet(f"{folder}/lineitem.parquet")
    for service in TIME_PREFIX:
        lineitem.trips(spark, folder, service).write.parquet(f"{folder}/{service}")
    lineitem.zones(spark, SF_DIR).write.parquet(f"{folder}/zones")


def plain_valid(clean: DataFrame) -> DataFrame:
    """Validity with built-in rounding of every trip's duration and speed."""
    seconds = F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")
    timed = clean.withColumn("trip_duration_min", F.round(seconds / 60, 2))
    speed = F.try_divide(F.col("trip_distance"), F.col("trip_duration_min") / 60)
    moving = timed.withColumn("avg_speed_mph", F.round(speed, 2))
    return moving.filter(
        "trip_duration_min > 0 AND trip_duration_min < 300 AND avg_speed_mph < 100"
    )


def group(report: reports.Report, trips: DataFrame, zones: DataFrame) -> DataFrame:
    parts = with_parts(with_keys(trips, report.by), report.measures)
    totals = trip_totals(parts, report.by, report.measures)
    return reports.finish(report, with_metrics(totals, report.by, report.metrics), zones)


def main(copies: int, folder: str) -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not os.path.exists(f"{folder}/zones"):
        write_inputs(spark, copies, folder)
    raw = {service: read_trips(spark, f"{folder}/{service}") for service in TIME_PREFIX}
    zones = read_zones(spark, f"{folder}/zones")
    early = [r for r in reports.REPORTS if r.scope != reports.VALID]
    late = [r for r in reports.REPORTS if r.scope == reports.VALID]

    def shared_scan() -> Results:
        path = f"{folder}/summary-{uuid.uuid4().hex}"
        summary.summarize(normalize_all(raw)).write.partitionBy(summary.SLICE).parquet(path)
        return [
            summary.report_from_summary(report, spark.read.parquet(path), zones).collect()
            for report in early + late
        ]

    def scan_per_report() -> Results:
        return [
            reports.build(report, clean_trips(canonical_trips(raw)), zones).collect()
            for report in early + late
        ]

    def persisted() -> Results:
        clean = clean_trips(canonical_trips(raw))
        valid = valid_trips(clean).persist()
        first = [reports.build(report, clean, zones).collect() for report in early]
        second = [group(report, valid, zones).collect() for report in late]
        valid.unpersist(blocking=True)
        return first + second

    def plain_expressions() -> Results:
        clean = clean_trips(canonical_trips(raw))
        first = [reports.build(report, clean, zones).collect() for report in early]
        return first + [group(report, plain_valid(clean), zones).collect() for report in late]

    variants: tuple[Callable[[], Results], ...] = (
        shared_scan,
        scan_per_report,
        persisted,
        plain_expressions,
    )
    print(f"{canonical_trips(raw).count()} trips, {CPUS} threads")
    results = {}
    for variant in variants:
        seconds = []
        for _ in range(2):
            start = time.perf_counter()
            results[variant] = [sorted(rows, key=str) for rows in variant()]
            seconds.append(time.perf_counter() - start)
        if results[variant] != results[shared_scan]:
            raise SystemExit(f"{variant.__name__} gives other reports")
        print(f"{variant.__name__}: {min(seconds):.1f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]), sys.argv[2])
