"""Parquet sink for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def report_path(base: str, name: str) -> str:
    """Directory of a report below ``base``, which may end in slashes."""
    return f"{base.rstrip('/')}/{name}_report"


def write_report(report: DataFrame, base: str, name: str) -> str:
    """Replace the directory of the report and return its path."""
    path = report_path(base, name)
    report.write.mode("overwrite").parquet(path)
    return path
