"""Reading only the files that can hold trips since a date.

Folders by year and month do not tell what is in a file: stray dates are
common, and a trip of January may lie in the file of December. So each file's
first and last time is taken once, from one column of the file, and kept in a
table. A file whose last time is before the date is left out when Spark plans
the scan; every other file is read, and rows are filtered as before.

A row of the table holds a file's path, size and time of change, so a file
written anew is looked at anew. Files without a row, such as those of no trip
or without the column, are read. Each update writes a folder of its own: jobs
may update one table at the same time, and rows that say the same do no harm.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.sinks.publish import Store, listed_files
from waybill.sources.parquet import trip_parts, union_parts

_TABLE = "_time_ranges"
_SCHEMA = "file string, bytes bigint, changed bigint, column string, last bigint"
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
#: A local time is a different instant in another session's zone, by 36 hours at most.
_MARGIN_HOURS = 48

_PATH = "_metadata.file_path"


def _file_rows(part: DataFrame, column: str, files: Iterable[str]) -> DataFrame:
    """A row per file of ``files`` that has trips; reads one column."""
    last = F.unix_micros(F.max(F.col(column).cast("timestamp")))
    changed = F.unix_millis("_metadata.file_modification_time")
    return (
        part.filter(F.col(_PATH).isin(*files))
        .groupBy(
            F.col(_PATH).alias("file"),
            F.col("_metadata.file_size").alias("bytes"),
            changed.alias("changed"),
        )
        .agg(last.alias("last"))
        .select("file", "bytes", "changed", F.lit(column).alias("column"), "last")
    )


def _named(path: str) -> str:
    """A path of ``inputFiles`` as ``_metadata.file_path`` has it: file:/a, not file:///a."""
    return re.sub(r"^([^:/]+):///", r"\1:/", path)


def _known(spark: SparkSession, folder: str, column: str) -> dict[tuple, int | None]:
    """(file, bytes, changed) -> last time, of all files looked at so far."""
    table = spark.read.schema(_SCHEMA).parquet(f"{folder}/{_TABLE}/*")
    rows = table.filter(F.col("column") == column).collect()
    return {(row["file"], row["bytes"], row["changed"]): row["last"] for row in rows}


def update_ranges(
    spark: SparkSession, parts: list[DataFrame], column: str, folder: str
) -> dict[str, int | None]:
    """Last times by file, NULL for one of NULLs only, after a look at the files not known yet.

    ``parts`` are plain reads of Parquet files and ``folder`` is one that all
    executors see. The driver holds a row per file, as Spark does to plan a scan.
    """
    folder = folder.rstrip("/")
    dated = [part for part in parts if _time_column(part, column)]
    listed = [
        {_named(file): state for file, state in listed_files(spark, part).items()} for part in dated
    ]
    known = _known(spark, folder, column) if _has_table(spark, folder) else {}
    rows = [
        _file_rows(part, column, missing)
        for part, files in zip(dated, listed)
        if (missing := [f for f, state in files.items() if (f, *state) not in known])
    ]
    if rows:
        # One task's worth of rows: a number or two for each new file.
        path = f"{folder}/{_TABLE}/{uuid.uuid4().hex}"
        reduce(DataFrame.unionAll, rows).write.parquet(path)
        known = _known(spark, folder, column)
    return {
        file: known[(file, *state)]
        for files in listed
        for file, state in files.items()
        if (file, *state) in known
    }


def _has_table(spark: SparkSession, folder: str) -> bool:
    return bool(Store(spark, folder).names(f"{folder}/{_TABLE}"))


def _time_column(part: DataFrame, column: str) -> bool:
    return any(f.name.lower() == column.lower() and isinstance(f.dataType, _TIMES) for f in part.schema)


def _micros(spark: SparkSession, since: str) -> int:
    moment: Column = F.lit(since).cast("timestamp") - F.expr(f"INTERVAL {_MARGIN_HOURS} HOURS")
    return spark.range(1).select(F.unix_micros(moment)).first()[0]


def read_trips_since(
    spark: SparkSession, path: str, column: str, since: str, folder: str
) -> DataFrame:
    """``read_trips`` without files in which no ``column`` is on or after ``since``.

    Same columns and types as ``read_trips(spark, path)``. Rows before the
    date are left in the files that are read, so the filter is still needed;
    rows without a time may be left out with their file, as the filter would.
    """
    parts = trip_parts(spark, path)
    bound = _micros(spark, since)
    last = update_ranges(spark, parts, column, folder)
    early = {file for file, time in last.items() if time is None or time < bound}

    def kept(part: DataFrame) -> DataFrame:
        skipped = sorted(early.intersection(map(_named, part.inputFiles())))
        return part.filter(~F.col(_PATH).isin(*skipped)) if skipped else part

    return union_parts([kept(part) for part in parts])
