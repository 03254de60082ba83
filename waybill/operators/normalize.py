"""From service-specific trips to one canonical relation."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.schema import (
    SERVICE,
    TRIP_COLUMNS,
    check_same_kinds,
    check_types,
    source_layout,
)


def normalize(raw: DataFrame, service: str) -> DataFrame:
    """Rename and prune one service's trips to the canonical columns."""
    renamed = [F.col(source).alias(name) for name, source in source_layout(service).items()]
    return check_types(raw.select(*renamed, F.lit(service).alias(SERVICE)))


def union_trips(first: DataFrame, second: DataFrame) -> DataFrame:
    """Bag union by name, in canonical column order; a missing column is an error."""
    columns = list(TRIP_COLUMNS)
    return first.select(columns).unionByName(second.select(columns))


def union_common_columns(services: Mapping[str, DataFrame]) -> DataFrame:
    """Bag union of raw relations over the columns that all of them have.

    Names are compared as the session resolves them, in upper or lower case
    alike unless ``spark.sql.caseSensitive`` is set; the spelling of the first
    service stays. Columns of one name must be of one kind: times, numbers, or
    else the same type.
    """
    spark = next(iter(services.values())).sparkSession
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"

    def fold(name: str) -> str:
        return name if exact else name.lower()

    held = [{fold(name): name for name in raw.columns} for raw in services.values()]
    common = [key for key in held[0] if all(key in names for names in held)]
    tagged = []
    for (service, raw), names in zip(services.items(), held):
        columns = [F.col(f"`{names[key]}`").alias(held[0][key]) for key in common]
        tagged.append(raw.select(*columns, F.lit(service).alias(SERVICE)))
    check_same_kinds(tagged)
    return reduce(DataFrame.unionByName, tagged)


def normalize_all(services: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Canonical trips of every service, not yet united but of the types of their union.

    Whatever is computed per service thus sees the same values as after the
    union, e.g. zoned times where only one service stores a time zone.
    """
    canonical = {service: normalize(raw, service) for service, raw in services.items()}
    wanted = reduce(union_trips, canonical.values()).schema
    return {
        service: trips.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted))
        for service, trips in canonical.items()
    }


def canonical_trips(services: Mapping[str, DataFrame]) -> DataFrame:
    """All raw services as one canonical relation, before any cleaning."""
    return reduce(union_trips, normalize_all(services).values())
