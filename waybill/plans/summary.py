"""One scan of the trips for all ten reports.

The reports group the same trips by a few short keys. Computing them one by
one reads the sources ten times; caching the trips would need room for the
whole input. Instead one aggregation per service keeps partial totals for each
slice of the keys. A trip becomes a row per slice, with that slice's keys and
the few measures that its reports show: measures that never meet in a slice
share a slot, so the buffers of the aggregation are as narrow as the widest
slice. Trips are reduced inside the scan tasks, so what is shuffled is at most
one row per task and distinct key, however unevenly trips spread over the keys.
Only the slice of codes serves reports on clean trips; for reports the other
slices hold valid trips alone. The whole summary, asked for without reports, has
all trips and all measures in every slice.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions import calendar, trip
from waybill.functions.exact import LAYER, PARTS, USUAL, with_parts
from waybill.operators.attributes import with_keys
from waybill.operators.quality import fill_payment_type, start_of, with_duration, with_speed
from waybill.plans.metrics import ROWS, group_totals, partial_totals, with_metrics
from waybill.plans.reports import CLEAN, RECENT, REPORTS, VALID, Report, finish
from waybill.rules import DEFAULT_RULES, Rules
from waybill.schema import SERVICE

# The keys of each slice, besides the service and the validity flag.
SLICES = {
    "codes": ("payment_type", "RatecodeID", "year", RECENT),
    "pickup": ("PULocationID",),
    "dropoff": ("DOLocationID",),
    "clock": ("hour", "weekday"),
}
SLICE = "slice"
CODES = "codes"

MEASURES = tuple(dict.fromkeys(m for report in REPORTS for m in report.measures))


def slice_of(report: Report) -> str:
    """The slice whose keys can answer a report."""
    needed = {"year" if key == "era" else key for key in report.by} - {SERVICE}
    if report.scope != VALID:
        needed.add("RatecodeID")
    return next(name for name, keys in SLICES.items() if needed <= set(keys))


def _measures(reports: Iterable[Report] | None) -> dict[str, list[str]]:
    """The slices that are needed, and the measures that each of them adds up; None needs all."""
    if reports is None:
        return {name: list(MEASURES) for name in SLICES}
    found: dict[str, list[str]] = {}
    for report in reports:
        mine = found.setdefault(slice_of(report), [])
        mine += [measure for measure in report.measures if measure not in mine]
    return found


def _slots(needed: Mapping[str, list[str]]) -> dict[str, int]:
    """A slot for each measure; measures of one slice have slots of their own, others share."""
    slots: dict[str, int] = {}
    for measure in dict.fromkeys(m for mine in needed.values() for m in mine):
        beside = {m for mine in needed.values() if measure in mine for m in mine}
        taken = {slots[m] for m in beside if m in slots}
        slots[measure] = min(set(range(len(taken) + 1)) - taken)
    return slots


def _by_slice(trips: DataFrame, needed: Mapping[str, list[str]], slots: Mapping[str, int]):
    """A row per trip and slice, with that slice's keys and the parts of its measures only."""
    keys = [key for name in needed for key in SLICES[name]]
    width = max(slots.values(), default=-1) + 1
    nothing = {f"no_{key}": F.lit(None).cast(trips.schema[key].dataType) for key in keys}
    nothing["no_part"] = F.lit(None).cast("long")
    rows = []
    for name, measures in needed.items():
        columns = [key if key in SLICES[name] else f"no_{key}" for key in keys]
        held = {slots[measure]: measure for measure in measures}
        for slot in range(width):
            parts = [f"{held[slot]}_{part}" if slot in held else "no_part" for part in PARTS]
            columns += parts
        rows.append(f"({', '.join(f'`{c}`' for c in columns)}) AS `{name}`")
    names = keys + [f"slot{slot}_{part}" for slot in range(width) for part in PARTS]
    used = {c for measures in needed.values() for m in measures for c in (f"{m}_{p}" for p in PARTS)}
    given = trips.select(LAYER, VALID, *keys, *sorted(used)).withColumns(nothing)
    return trips.sparkSession.sql(
        f"SELECT * FROM {{trips}} UNPIVOT INCLUDE NULLS (({', '.join(f'`{n}`' for n in names)})"
        f" FOR {SLICE} IN ({', '.join(rows)}))",
        trips=given,
    ).select(LAYER, VALID, SLICE, *names)


def summarize_service(
    trips: DataFrame,
    rules: Rules = DEFAULT_RULES,
    reports: Iterable[Report] | None = REPORTS,
) -> DataFrame:
    """Partial totals per slice, from the canonical trips of one service.

    Only the slices that ``reports`` need are kept, and in each of them the
    measures that they need there. In the slice of codes, rows that cleaning
    would drop stay in, told apart by their rate code and the validity flag, so
    that raw row counts come out of the same scan. The other slices hold valid
    trips only. With None for ``reports``, every slice holds all trips, valid or
    not, and adds up all measures.
    """
    needed = _measures(reports)
    slots = _slots(needed)
    keys = [key for name in needed for key in SLICES[name]]

    derived = with_speed(with_duration(fill_payment_type(trips, rules)))
    accepted = trip.known_ratecode(F.col("RatecodeID"), rules) & trip.plausible(
        F.col("trip_distance"), F.col("trip_duration_min"), rules
    )
    recent = F.col("pickup_datetime") >= start_of(trips, rules)
    flagged = derived.withColumns(
        {VALID: F.coalesce(accepted, F.lit(False)), RECENT: F.coalesce(recent, F.lit(False))}
    )
    if CODES not in needed:
        flagged = flagged.filter(VALID)
    sliced = _by_slice(with_parts(with_keys(flagged, keys), slots), needed, slots)
    if reports is not None:
        sliced = sliced.filter((F.col(SLICE) == CODES) | F.col(VALID))
    width = max(slots.values(), default=-1) + 1
    totals = sliced.groupBy(SLICE, LAYER, VALID, *keys).agg(
        *partial_totals(f"slot{slot}" for slot in range(width))
    )
    shown = []
    for measure, slot in slots.items():
        holders = [name for name, held in needed.items() if measure in held]
        for part in (*PARTS, "n"):
            value = F.col(f"slot{slot}_{part}")
            if len(holders) < len(needed):
                value = F.when(F.col(SLICE).isin(holders), value)
            shown.append(value.alias(f"{measure}_{part}"))
    return totals.select(VALID, *keys, SLICE, LAYER, ROWS, *shown)


def summarize(
    services: Mapping[str, DataFrame],
    rules: Rules = DEFAULT_RULES,
    reports: Iterable[Report] | None = REPORTS,
) -> DataFrame:
    """Partial totals of canonical trips per service and slice.

    Each service is aggregated before the union: its name needs no place in
    the grouping key, and scan to partial totals is one stage of generated code.
    With None for ``reports`` it is the whole summary.
    """
    reports = None if reports is None else tuple(reports)
    parts = [
        summarize_service(trips, rules, reports).withColumn(SERVICE, F.lit(service))
        for service, trips in services.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def report_from_summary(
    report: Report,
    summary: DataFrame,
    zones: DataFrame | None = None,
    rules: Rules = DEFAULT_RULES,
    limbs: bool = True,
) -> DataFrame:
    """Compute a report from the summary instead of the trips.

    Without ``limbs`` the summary must hold layer 0 alone; see ``has_limbs``.
    """
    known = trip.known_ratecode(F.col("RatecodeID"), rules)
    wanted = {CLEAN: known, RECENT: known & F.col(RECENT), VALID: F.col(VALID)}
    rows = summary.filter((F.col(SLICE) == slice_of(report)) & wanted[report.scope])
    if not report.measures:
        rows = rows.filter(F.col(LAYER) == USUAL)
    if "era" in report.by:
        rows = rows.withColumn("era", calendar.era(F.col("year"), rules))
    totals = group_totals(rows, report.by, report.measures, limbs and bool(report.measures))
    return finish(report, with_metrics(totals, report.by, report.metrics), zones)


def source_counts(summary: DataFrame) -> DataFrame:
    """Raw rows per service."""
    codes = summary.filter((F.col(SLICE) == CODES) & (F.col(LAYER) == USUAL))
    return codes.groupBy(SERVICE).agg(F.sum(ROWS).alias("row_count"))


def has_limbs(summary: DataFrame) -> bool:
    """Whether some amount was too unusual for layer 0."""
    return not summary.filter(F.col(LAYER) != USUAL).isEmpty()
