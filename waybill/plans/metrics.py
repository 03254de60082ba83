"""Report metrics, computed from partial totals.

Every metric of the reports is a row count, a total or a mean. Trips are added
up per group and layer (``partial_totals``); whatever holds such sums, trips of
one report or the summary of a shared scan, gives the same value and type
(``group_totals``): counts are long, totals and means double, whatever number
type a source uses.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.exact import LAYER, PARTS, USUAL, limbs_of, round_total

ROWS = "trip_rows"
LIMBS = "limbs"


def partial_totals(measures: Iterable[str]) -> list[Column]:
    """The row count, and sums of the parts and a non-NULL count for every measure.

    They are right per layer: the counts that matter are those of layer 0.
    """
    totals = [F.count("*").alias(ROWS)]
    for measure in measures:
        names = [f"{measure}_{part}" for part in PARTS]
        totals += [F.sum(name).alias(name) for name in names]
        totals.append(F.count(names[0]).alias(f"{measure}_n"))
    return totals


def _across_layers(per_layer: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """Sums of layer 0, and in an array those of other layers, of rows per group and layer."""
    names = [ROWS, *_names(measures)]
    sums = [F.expr(f"sum(IF({LAYER} = {USUAL}, {name}, NULL))").alias(name) for name in names]
    return per_layer.groupBy(*by).agg(*sums, limbs_of(measures).alias(LIMBS))


def _names(measures: Iterable[str]) -> list[str]:
    return [f"{measure}_{name}" for measure in measures for name in (*PARTS, "n")]


def trip_totals(trips: DataFrame, by: Iterable[str], measures: Iterable[str]) -> DataFrame:
    """Totals per group of trips ``with_parts``."""
    by, measures = list(by), list(dict.fromkeys(measures))
    per_layer = trips.groupBy(*by, LAYER).agg(*partial_totals(measures))
    if not measures:
        return per_layer
    return _across_layers(per_layer, by, measures)


def group_totals(
    rows: DataFrame, by: Iterable[str], measures: Iterable[str], limbs: bool = True
) -> DataFrame:
    """The same from rows of partial totals, each of one layer.

    Without ``limbs`` all rows must be of layer 0; then one aggregation will do.
    """
    by, measures = list(by), list(dict.fromkeys(measures))
    sums = [F.sum(name).alias(name) for name in (ROWS, *_names(measures))]
    if not limbs:
        return rows.groupBy(*by).agg(*sums)
    return _across_layers(rows.groupBy(*by, LAYER).agg(*sums), by, measures)


@dataclass(frozen=True)
class Rows:
    name: str

    def value(self, limbs: str | None) -> Column:
        return F.col(ROWS).alias(self.name)


@dataclass(frozen=True)
class Total:
    name: str
    measure: str
    per: int = 1

    def value(self, limbs: str | None) -> Column:
        return round_total(self.measure, str(self.per), limbs).alias(self.name)


@dataclass(frozen=True)
class Mean:
    name: str
    measure: str

    def value(self, limbs: str | None) -> Column:
        return round_total(self.measure, f"{self.measure}_n", limbs).alias(self.name)


def with_metrics(totals: DataFrame, by: Iterable[str], metrics: Iterable) -> DataFrame:
    """The metrics of groups from their ``group_totals``."""
    limbs = LIMBS if LIMBS in totals.columns else None
    return totals.select(*by, *(metric.value(limbs) for metric in metrics))
