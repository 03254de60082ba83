"""The batch job: four paths in, ten Parquet reports out."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waybill.operators.normalize import normalize_all, union_trips
from waybill.operators.quality import clean_trips
from waybill.plans import resume
from waybill.plans.reports import FARES, RECENT, REPORTS, Report, build, register_trips
from waybill.plans.summary import (
    SLICE,
    has_limbs,
    report_from_summary,
    source_counts,
    summarize,
)
from waybill.rules import DEFAULT_RULES, Rules
from waybill.schema import SERVICE, source_layout
from waybill.sinks.parquet import write_report
from waybill.sinks.publish import publish
from waybill.sources.parquet import read_trips, read_zones
from waybill.sources.ranges import read_trips_since

log = logging.getLogger(__name__)

CHECKPOINT_SETTING = "spark.checkpoint.dir"
LOG_LEVEL = "INFO"
# The report whose scan counts the raw trips if there is no shared one.
COUNTING = FARES


def stage(
    spark: SparkSession, summary: DataFrame, staging: str, made_from: dict | None = None
) -> DataFrame:
    """Write the summary below ``staging`` and return it as read back.

    The copy outlives any executor, so no report repeats the scan behind it,
    and each report reads the files of its own slice only. It is not removed:
    the owner of the folder expires it, like checkpoints.
    """
    path = resume.new_summary(staging, made_from)
    summary.write.partitionBy(SLICE).parquet(path)
    if made_from:
        resume.finished(spark, path, made_from, summary.schema.json())
    return spark.read.schema(summary.schema).parquet(path)


def staging_folder(spark: SparkSession, staging: str | None, output: str) -> str:
    """Where intermediate data goes: ``staging`` or else the cluster's checkpoint folder.

    Every executor must see it, and it must not lie in the published output.
    """
    folder = staging or spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        raise ValueError(f"give a shared staging folder, or set {CHECKPOINT_SETTING}")
    if f"{folder.rstrip('/')}/".startswith(f"{output.rstrip('/')}/"):
        raise ValueError(f"the staging folder {folder} lies in the output {output}")
    return folder


def _summary(
    spark: SparkSession,
    canonical: Mapping[str, DataFrame],
    rules: Rules,
    staging: str,
    made_from: dict | None,
) -> DataFrame:
    """The staged summary: of an earlier run that failed after it, or a new one."""
    found = resume.find(spark, staging, made_from) if made_from else None
    if found:
        path, schema = found
        log.info("going on with %s", path)
        return spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(path)
    return stage(spark, summarize(canonical, rules), staging, made_from)


def _counted(canonical: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], dict]:
    """The same trips, which count themselves per service while a report reads them."""
    watches = {service: Observation() for service in canonical}
    watched = {
        service: trips.observe(watches[service], F.count(F.lit(1)).alias("row_count"))
        for service, trips in canonical.items()
    }
    return watched, watches


def _observed(watch: Observation) -> int:
    """The rows counted; Spark leaves a source without any out of the plan, and notes nothing."""
    try:
        return watch.get["row_count"]
    except Py4JJavaError as error:
        if "assertion failed" not in str(error):
            raise
        return 0


def write_reports(
    services: Mapping[str, DataFrame],
    zones: DataFrame,
    output: str,
    rules: Rules = DEFAULT_RULES,
    shared_scan: bool = True,
    staging: str | None = None,
    made_from: dict | None = None,
    recent: Mapping[str, DataFrame] | None = None,
) -> dict[str, str]:
    """Write all reports on raw trips and publish them below ``output``; returns name -> directory.

    With ``shared_scan`` the trips are read once; ``made_from`` lets a run go
    on with the summary of one that failed. Without, every report reads the
    columns it needs, one report after the other, and the first full scan
    counts the trips. ``recent`` are the same raw trips, some of those before the
    start date left out, for the reports that do not need them. If any report
    fails, none is replaced.
    """
    spark = zones.sparkSession
    canonical = normalize_all(services)
    clean = clean_trips(reduce(union_trips, canonical.values()), rules)
    register_trips(clean)

    def note(counts: dict[str, int]) -> None:
        log.info("trips read: %s, %d in all", counts, sum(counts.values()))

    summary, limbs, watches = None, True, {}
    if shared_scan:
        folder = staging_folder(spark, staging, output)
        summary = _summary(spark, canonical, rules, folder, made_from)
        note({row[SERVICE]: row["row_count"] for row in source_counts(summary).collect()})
        limbs = has_limbs(summary)
    else:
        watched, watches = _counted(canonical)
        counting = clean_trips(reduce(union_trips, watched.values()), rules)
        late = clean
        if recent:
            late = clean_trips(reduce(union_trips, normalize_all(recent).values()), rules)

    def write(report: Report, fresh: str) -> None:
        if shared_scan:
            frame = report_from_summary(report, summary, zones, rules, limbs)
        else:
            trips = late if report.scope == RECENT else clean
            frame = build(report, counting if report is COUNTING else trips, zones, rules)
        write_report(frame, fresh, report.name)
        if watches and report is COUNTING:
            note({service: _observed(watch) for service, watch in watches.items()})
        log.info("wrote %s", report.name)

    def write_all(fresh: str) -> None:
        # Reports from the summary are tiny jobs, so they are submitted together;
        # full scans would only get in each other's way.
        with ThreadPoolExecutor(len(REPORTS) if shared_scan else 1) as pool:
            for _ in pool.map(lambda report: write(report, fresh), REPORTS):
                pass

    paths = publish(spark, output, [report.name for report in REPORTS], write_all)
    log.info("published %s", ", ".join(paths.values()))
    if shared_scan and made_from:
        found = resume.find(spark, folder, made_from)
        if found:
            resume.done(spark, found[0])
    return paths


def run(
    spark: SparkSession,
    input_green: str,
    input_yellow: str,
    input_zones: str,
    output: str,
    rules: Rules = DEFAULT_RULES,
    shared_scan: bool = True,
    staging: str | None = None,
) -> dict[str, str]:
    """Read the three Parquet inputs and write all reports below ``output``.

    ``staging`` is a folder that all executors see, outside of ``output``; by
    default it is the cluster's checkpoint folder. Without ``shared_scan`` it
    keeps a table of each file's last pick-up, and reports from the start date
    on read only the files that reach it.
    """
    inputs = {"green": input_green, "yellow": input_yellow}
    services = {service: read_trips(spark, path) for service, path in inputs.items()}
    zones = read_zones(spark, input_zones)
    made_from = resume.manifest(spark, services, rules)
    recent, ranges = None, staging or spark.conf.get(CHECKPOINT_SETTING, None)
    if ranges and not shared_scan:
        recent = {
            service: read_trips_since(
                spark, path, source_layout(service)["pickup_datetime"], rules.since, ranges
            )
            for service, path in inputs.items()
        }
    return write_reports(services, zones, output, rules, shared_scan, staging, made_from, recent)


def main(argv: list[str] | None = None) -> None:
    """Entry point for ``spark-submit``."""
    parser = argparse.ArgumentParser(description="Write the ten trip reports")
    for option in ("input_green", "input_yellow", "input_zones", "output"):
        parser.add_argument(f"--{option}", required=True, metavar="PATH")
    parser.add_argument("--staging", metavar="PATH", help="shared folder for intermediate data")
    paths = vars(parser.parse_args(argv))
    logging.basicConfig(level=logging.INFO)
    with SparkSession.builder.appName("waybill").getOrCreate() as spark:
        spark.sparkContext.setLogLevel(LOG_LEVEL)
        run(spark, **paths)


if __name__ == "__main__":
    main()
