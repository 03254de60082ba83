"""Totals of doubles that are the same in any order and lose no digit.

A double is taken apart into whole numbers, whose sums as longs merge in any
order. Nearly all amounts are a decimal of up to six places, or such a decimal
and a little noise of binary arithmetic. Rows of such amounts have three parts
for each of them, all in layer 0: whole units, millionths, and what the double
has beyond the nearest millionth in units of 2^-64.

A row with another amount (4,194,304 or more, more decimals, bits below 2^-64)
has all its amounts cut by exponent into limbs of 24 bits, each in a layer of
its own: a row more per layer, where the limb takes the place of the whole
units. So a buffer has room for usual amounts only, and yet any finite double
is added exactly. NaN and the infinities have a layer each.

Parts are below 2^24, so a group has room for 2^39 rows.

The steps are as small as they are because the JVM compiles no method of more
than 8,000 bytes, and Spark makes one of all steps between two exchanges.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAYER = "layer"
PARTS = ("whole", "millionths", "fine")

USUAL = 0
_NAN, _PLUS, _MINUS = 1, 2, 3
# Limbs have the layers from here on: the one of 2^0 to 2^23 is in the middle.
_FIRST_LIMB, _MIDDLE = 100, 200
_BITS = 24
_LIMB = 1 << _BITS
_BELOW = f"{1 << 22}D"
_FINE = f"{1 << 64}D"
_INFINITY = "CAST('Infinity' AS DOUBLE)"
_NEAR = "rint({v} * 1000000D) / 1000000D"
# NaN is above all other doubles, and whatever is not a number equals nothing that is.
_IS_USUAL = f"abs({{v}}) < {_BELOW} AND abs({{x}}) < {_BELOW} AND rint({{x}}) = {{x}}"
# All layers of doubles, and those of rows whose bits lie between 2^-120 and 2^48.
_ALL = (_NAN, _PLUS, _MINUS, *range(155, 243))
_NEARBY = range(195, 202)
_LAYERS = f"""IF(layer_usual, array({USUAL}),
  IF({{most}} < {1 << 48}D AND {{least}} >= {2.0**-67!r}D,
    array({USUAL}, {', '.join(map(str, _NEARBY))}), array({USUAL}, {', '.join(map(str, _ALL))})))"""
# The square of the power is what a limb is shifted by; it may be too large for a double.
_POWER = f"pow(2D, CAST(({_MIDDLE} - {LAYER}) * {_BITS // 2} AS DOUBLE))"
_ODD = f"""CASE WHEN {LAYER} = {_PLUS} THEN {_INFINITY} WHEN {LAYER} = {_MINUS} THEN -{_INFINITY}
  ELSE CAST('NaN' AS DOUBLE) END"""
# Where the product is too large, the amount has no bit in this layer.
_LIMB_OF = f"""IF({LAYER} >= {_FIRST_LIMB},
  IF({{v}} < 0D, -1L, 1L) * floor((abs({{v}}) * layer_power * layer_power) % {_LIMB}D),
  IF({{v}} = layer_odd, 1L, 0L))"""


def with_parts(rows: DataFrame, measures: Iterable[str]) -> DataFrame:
    """Rows with their layers and the parts of every measure.

    A row with usual amounts only stays one row, in layer 0. Others have a row
    more for each layer, which counts for nothing but its amounts. The parts
    are 0 where the amount is NULL, but for the whole units, which are NULL.
    """
    measures = tuple(dict.fromkeys(measures))
    if not measures:
        return rows.withColumn(LAYER, F.lit(USUAL))
    values = {m: f"{m}_value" for m in measures}
    rows = rows.withColumns(
        {v: F.expr(f"coalesce(CAST(`{m}` AS DOUBLE), 0D)") for m, v in values.items()}
    )
    beyond = {m: f"{m}_beyond" for m in measures}
    rows = rows.withColumns(
        {x: F.expr(f"({values[m]} - {_NEAR.format(v=values[m])}) * {_FINE}") for m, x in beyond.items()}
    )
    usual = " AND ".join(_IS_USUAL.format(v=values[m], x=x) for m, x in beyond.items())
    rows = rows.withColumn("layer_usual", F.expr(usual)).drop(*beyond.values())
    sizes = [f"abs({v})" for v in values.values()]
    nonzero = [f"IF({v} = 0D, 1D, abs({v}))" for v in values.values()]
    most, least = (
        f"{name}({', '.join(of)})" if len(of) > 1 else of[0]
        for name, of in (("greatest", sizes), ("least", nonzero))
    )
    layers = _LAYERS.format(most=most, least=least)
    layered = rows.withColumn(LAYER, F.explode(F.expr(layers))).withColumns(
        {
            "layer_power": F.expr(_POWER),
            "layer_odd": F.expr(_ODD),
            **{f"{m}_near": F.expr(_NEAR.format(v=v)) for m, v in values.items()},
        }
    )
    parts = {}
    for m, v in values.items():
        near = f"{m}_near"
        whole = f"IF(layer_usual, floor({near}), {_LIMB_OF.format(v=v)})"
        parts[f"{m}_whole"] = f"IF(`{m}` IS NULL, NULL, {whole})"
        parts[f"{m}_millionths"] = (
            f"IF(layer_usual, floor(rint(({near} - floor({near})) * 1000000D)), 0L)"
        )
        parts[f"{m}_fine"] = f"IF(layer_usual, floor(({v} - {near}) * {_FINE}), 0L)"
    used = [*values.values(), *(f"{m}_near" for m in measures)]
    layered = layered.withColumns({name: F.expr(part) for name, part in parts.items()})
    return layered.drop("layer_power", "layer_odd", "layer_usual", *used)


def limbs_of(measures: Iterable[str]) -> Column:
    """An aggregate: the group's sums outside of layer 0, one struct per layer."""
    sums = ", ".join(f"{m}_whole" for m in dict.fromkeys(measures))
    return F.expr(f"collect_list(IF({LAYER} <> {USUAL}, struct({LAYER}, {sums}), NULL))")


def _sum_of_limbs(limbs: str, measure: str) -> str:
    """The total of the limbs of ``measure``, as a double next to the exact one.

    Carries move to the limb above, so that limbs end between -2^23 and 2^23
    and nothing cancels when they are put together.
    """
    wide = "DECIMAL(38, 0)"
    mine = f"filter({limbs}, x -> x.{LAYER} >= {_FIRST_LIMB} AND x.{measure}_whole <> 0)"
    by_layer = (
        f"map_from_entries(transform({mine}, x -> struct(x.{LAYER}, CAST(x.{measure}_whole AS {wide}))))"
    )

    def has(layer: int) -> str:
        return f"exists({limbs}, x -> x.{LAYER} = {layer} AND x.{measure}_whole > 0)"

    # Five limbs above the uppermost take up what a sum of longs carries.
    carried = f"""aggregate(
  sequence(array_min(map_keys(held)), array_max(map_keys(held)) + 5),
  struct(CAST(0 AS {wide}) AS carry, 0D AS below),
  (so_far, layer) -> transform(
    array(so_far.carry + coalesce(try_element_at(held, layer), CAST(0 AS {wide}))),
    total -> struct(
      CAST(floor(total / {_LIMB} + 0.5) AS {wide}) AS carry,
      (CAST(total - CAST(floor(total / {_LIMB} + 0.5) AS {wide}) * {_LIMB} AS DOUBLE) + so_far.below)
        / {_LIMB}D AS below))[0],
  found -> transform(
    array(pow(2D, (array_max(map_keys(held)) + 6 - {_MIDDLE}) * {_BITS // 2})),
    power -> (CAST(found.carry AS DOUBLE) + found.below) * power * power)[0])"""
    return f"""CASE
  WHEN {has(_NAN)} OR ({has(_PLUS)} AND {has(_MINUS)}) THEN CAST('NaN' AS DOUBLE)
  WHEN {has(_PLUS)} THEN {_INFINITY}
  WHEN {has(_MINUS)} THEN -{_INFINITY}
  WHEN size({mine}) > 0 THEN transform(array({by_layer}), held -> {carried})[0]
  ELSE 0D END"""


def total_of(measure: str) -> str:
    """SQL of a group's total in layer 0, as a decimal; NULL without any amount."""
    whole, millionths, fine = (f"{measure}_{name}" for name in PARTS)
    return (
        f"(CAST({whole} AS DECIMAL(20, 0)) + coalesce(CAST({millionths} AS DECIMAL(20, 0)), 0) * 0.000001BD"
        f" + coalesce(CAST(CAST({fine} AS DOUBLE) / {_FINE} AS DECIMAL(38, 18)), 0))"
    )


def round_total(measure: str, per: str, limbs: str | None = None, places: int = 2) -> Column:
    """The total of a group's sums, divided by ``per`` and rounded half up to ``places``, once.

    The sums are those of layer 0 in the measure's columns and, if given, those
    of ``limbs_of``. NULL without any amount.
    """
    total = f"CAST({total_of(measure)} AS DECIMAL(38, 18))"
    rounded = f"CAST(round(try_divide({total}, CAST({per} AS DECIMAL(20, 0))), {places}) AS DOUBLE)"
    if limbs is None:
        return F.expr(rounded)
    whole = f"CAST({total} AS DOUBLE) + {_sum_of_limbs(limbs, measure)}"
    return F.expr(
        f"IF(size({limbs}) = 0, {rounded}, round(try_divide({whole}, CAST({per} AS DOUBLE)), {places}))"
    )
