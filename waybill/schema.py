"""The canonical trip relation and how each source maps onto it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from types import MappingProxyType

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Canonical column names and order.
TRIP_COLUMNS = (
    "pickup_datetime",
    "dropoff_datetime",
    "payment_type",
    "RatecodeID",
    "total_amount",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "congestion_surcharge",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "service_type",
)
SERVICE = "service_type"
# The two times have a prefix in each source; all others are named alike.
TIME_COLUMNS = ("pickup_datetime", "dropoff_datetime")
SHARED_COLUMNS = tuple(c for c in TRIP_COLUMNS if c not in (*TIME_COLUMNS, SERVICE))

# The prefix each service puts before its two time columns.
TIME_PREFIX = MappingProxyType({"green": "lpep_", "yellow": "tpep_"})


def source_layout(service: str) -> Mapping[str, str]:
    """Canonical name -> source name, in canonical order, for one service."""
    prefix = TIME_PREFIX[service]
    return {
        **{name: prefix + name for name in TIME_COLUMNS},
        **{name: name for name in SHARED_COLUMNS},
    }


class SchemaMismatch(ValueError):
    """A source column has a type the trip analytics cannot work with."""


def check_types(trips: DataFrame) -> DataFrame:
    """Return ``trips`` unchanged, or raise if a canonical column has a wrong type.

    Without the check a union of string and int columns would quietly turn
    into a numeric column and only fail, row by row, on the executors.
    """
    instants = (T.TimestampType, T.TimestampNTZType, T.DateType)
    numbers = (T.NumericType, T.NullType)
    wrong = [
        f"{field.name}: {field.dataType.simpleString()}"
        for field in trips.schema
        if (field.name in TIME_COLUMNS and not isinstance(field.dataType, instants))
        or (field.name in SHARED_COLUMNS and not isinstance(field.dataType, numbers))
    ]
    if wrong:
        raise SchemaMismatch("unusable trip columns: " + ", ".join(wrong))
    return trips


def check_same_kinds(relations: Sequence[DataFrame]) -> None:
    """Raise if columns of the same name cannot be united without a guess."""

    def kind(field: T.StructField) -> str:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return "time"
        if isinstance(field.dataType, T.NumericType):
            return "number"
        return field.dataType.simpleString()

    wrong = []
    for name in relations[0].columns:
        fields = [relation.schema[name] for relation in relations]
        kinds = {kind(field) for field in fields} - {"void"}
        if len(kinds) > 1:
            wrong.append(f"{name}: " + " and ".join(f.dataType.simpleString() for f in fields))
    if wrong:
        raise SchemaMismatch("columns of different kinds: " + ", ".join(wrong))
