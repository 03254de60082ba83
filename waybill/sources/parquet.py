"""Parquet readers for trips and zones."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Footers that the driver reads at a time where files differ.
FOOTERS_AT_ONCE = 32


def _kind(kind: T.DataType) -> str:
    """Kinds of which types widen to each other."""
    if isinstance(kind, T.NumericType):
        return "number"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "time"
    return kind.simpleString()


def _check_kinds(schemas: Iterable[T.StructType]) -> None:
    kinds: dict[str, str] = {}
    for schema in schemas:
        for field in schema:
            name, kind = field.name.lower(), _kind(field.dataType)
            if kinds.setdefault(name, kind) != kind:
                raise ValueError(f"files hold {field.name} as {kinds[name]} and as {kind}")


def drifting_parts(spark: SparkSession, files: list[str]) -> list[DataFrame]:
    """Files of different schemas, one read per schema, each with its own types."""

    def schema_of(file: str) -> T.StructType:
        return spark.read.parquet(file).schema

    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        schemas = [*pool.map(schema_of, files)]
    groups: dict[tuple, list[int]] = {}
    for i, schema in enumerate(schemas):
        like = tuple(sorted((f.name.lower(), f.dataType.simpleString()) for f in schema))
        groups.setdefault(like, []).append(i)
    _check_kinds(schemas[members[0]] for members in groups.values())
    return [
        spark.read.schema(schemas[members[0]]).parquet(*(files[i] for i in members))
        for members in groups.values()
    ]


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """Union by name: a column takes the wider of its types, and is NULL for parts without it."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_drifting(spark: SparkSession, files: list[str]) -> DataFrame:
    """Files of different schemas as one table.

    Files are grouped by the schema of their footers, each group is read with
    its own types, and the groups are joined by name. Numbers widen to numbers
    and times to times; anything else that differs is an error.
    """
    return union_parts(drifting_parts(spark, files))


def trip_parts(spark: SparkSession, path: str) -> list[DataFrame]:
    """Raw trips of one service as plain reads of files, one if their types agree."""
    plain = spark.read.parquet(path)
    files = plain.inputFiles()
    if len(files) < 2:
        return [plain]
    try:
        return [spark.read.option("mergeSchema", "true").parquet(path)]
    except Exception as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error) and "Failed to merge" not in str(error):
            raise
        return drifting_parts(spark, sorted(map(unquote, files)))


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Raw trips of one service; ``path`` may be a file, a directory or a glob.

    Monthly files drift: a column may be a long in one, a double in another and
    absent in a third. Spark compares their footers in one distributed job;
    where types differ the files are read by ``read_drifting``, which does not
    see columns of ``name=value`` directories.
    """
    return union_parts(trip_parts(spark, path))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup; only ``LocationID`` is named, other columns pass through."""
    return spark.read.parquet(path)
