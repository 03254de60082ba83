"""Zone lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame


def with_zone(left: DataFrame, zones: DataFrame, key: str) -> DataFrame:
    """Left join with all zone columns; unknown zones are kept with NULLs.

    No broadcast hint: Spark compares the size of the lookup with
    ``spark.sql.autoBroadcastJoinThreshold`` and broadcasts a city's zones,
    while a lookup that has grown beyond it is shuffled on the key.
    """
    return left.join(zones, left[key] == zones["LocationID"], "left")
