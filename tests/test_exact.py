"""Totals against exact arithmetic."""

from __future__ import annotations

import math
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waybill.functions.exact import LAYER, with_parts
from waybill.plans.metrics import (
    Mean,
    Rows,
    Total,
    group_totals,
    partial_totals,
    trip_totals,
    with_metrics,
)

KEEP_SESSION = settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
METRICS = (Total("total", "x"), Mean("mean", "x"), Rows("rows"))


def frame_of(spark, values, partitions=1):
    rows = [(1, None if v is None else float(v)) for v in values]
    return spark.createDataFrame(rows, "g int, x double").repartition(partitions)


def total_of(spark, values, partitions=1):
    parts = with_parts(frame_of(spark, values, partitions), ["x"])
    return with_metrics(trip_totals(parts, ["g"], ["x"]), [], METRICS).first()


def test_totals_are_rounded_once(spark):
    assert total_of(spark, [14.214999]).total == 14.21
    assert total_of(spark, [14.215]).total == 14.22
    assert total_of(spark, [-14.215]).total == -14.22
    assert total_of(spark, [14.21, 14.22]).mean == 14.22


def test_totals_do_not_depend_on_the_order(spark):
    values = [0.1 * i for i in range(1, 1000)]
    outcomes = set()
    for seed in range(5):
        random.Random(seed).shuffle(values)
        outcomes.add(total_of(spark, values, seed + 1).mean)
    assert outcomes == {50.0}


def test_totals_of_nothing_and_of_odd_amounts(spark):
    assert tuple(total_of(spark, [None, None])) == (None, None, 2)
    assert total_of(spark, [None, 1.5]).mean == 1.5
    assert total_of(spark, [1e300, 1.0]).total == 1e300
    assert total_of(spark, [math.inf, 1.0]).mean == math.inf
    assert math.isnan(total_of(spark, [math.nan, 1.0]).total)


@KEEP_SESSION
@given(st.lists(st.integers(-(10**10), 10**10), min_size=1, max_size=50))
def test_totals_equal_decimal_arithmetic(spark, cents):
    values = [c / 100 for c in cents]
    exact = sum(Decimal(c) / 100 for c in cents)
    row = total_of(spark, values, 3)
    assert row.total == float(exact)
    assert row.mean == float((exact / len(cents)).quantize(Decimal("0.01"), ROUND_HALF_UP)) + 0.0


def exact(values):
    return sum(map(Fraction, values))


def test_small_amounts_count(spark):
    """Amounts far below a millionth are added as they are."""
    amounts = spark.range(0, 10_000_000, numPartitions=4).select(
        F.lit(1).alias("g"), F.lit(1e-7).alias("x")
    )
    row = with_metrics(trip_totals(with_parts(amounts, ["x"]), ["g"], ["x"]), [], METRICS).first()
    assert (row.total, row.mean, row.rows) == (1.0, 0.0, 10_000_000)


@pytest.mark.parametrize("spread", [(0, 22), (22, 60), (-40, 10), (-1074, 1000)])
def test_any_doubles_in_any_partitioning(spark, spread):
    for seed in range(3):
        rng = random.Random(seed)
        values = [
            rng.choice((1, -1)) * math.ldexp(rng.random(), rng.randrange(*spread)) for _ in range(300)
        ]
        rows = {total_of(spark, values, partitions) for partitions in (1, 2, 5)}
        assert len(rows) == 1
        row = rows.pop()
        want = float(exact(values))
        assert row.total == pytest.approx(want, rel=4e-16, abs=0.0051)
        assert row.rows == 300


def test_large_amounts_cancel(spark):
    values = [1e20, 0.1, -1e20, 1e15, 1e-7, -1e15, 1.7e308, -1.7e308, 5e-324, 2.0**70, -(2.0**70)]
    assert total_of(spark, values, 3).total == 0.1
    assert total_of(spark, [2.0**70, -(2.0**70 - 2.0**20)], 2).total == 2.0**20
    assert total_of(spark, [-(2.0**48)] + [2.0**47] * 2 + [0.25], 2).total == 0.25


def test_noise_of_binary_arithmetic_keeps_one_layer(spark):
    """0.07 * 100 and the like have a row of their own in layer 0 only."""
    values = [k / 100 * 100 for k in range(30)] + [0.1 + 0.2, 4_194_303.99, -12.345678]
    parts = with_parts(frame_of(spark, values), ["x"]).collect()
    assert len(parts) == len(values)
    for row in parts:
        found = (
            Fraction(row.x_whole)
            + Fraction(row.x_millionths, 10**6)
            + Fraction(row.x_fine, 1 << 64)
        )
        # The nearest decimal of six places stands for its double.
        assert abs(found - Fraction(row.x)) <= Fraction(math.ulp(row.x)) / 2
        assert max(abs(row.x_millionths), abs(row.x_fine)) < 1 << 22


def test_layers_hold_what_is_unusual(spark):
    values = [1.5, 5e6, 1e-7, 1e300, math.nan, math.inf, None]
    parts = with_parts(frame_of(spark, values), ["x"])
    layers = {}
    for row in parts.collect():
        layers.setdefault(repr(row.x), set()).add(row[LAYER])
    assert layers["1.5"] == layers["None"] == {0}
    assert layers["5000000.0"] == layers["1e-07"] and len(layers["1e-07"]) == 8
    assert layers["nan"] == layers["inf"] == layers["1e+300"] and len(layers["nan"]) == 92


def test_infinities_and_nan(spark):
    assert total_of(spark, [math.inf, -math.inf, 1.0]).total != total_of(spark, [1.0]).total
    assert math.isnan(total_of(spark, [math.inf, -math.inf]).total)
    assert math.isnan(total_of(spark, [math.nan, math.inf]).mean)
    assert total_of(spark, [-math.inf, 1e300, 5.0]).mean == -math.inf


def test_several_measures_share_layers(spark):
    rows = [(g, float(g) / 10, 10.0**k, None) for g in (1, 2) for k in range(-9, 19, 3)]
    frame = spark.createDataFrame(rows, "g int, a double, b double, c double").repartition(3)
    measures = ["a", "b", "c"]
    metrics = [Total(m, m) for m in measures] + [Rows("rows")]
    totals = trip_totals(with_parts(frame, measures), ["g"], measures)
    got = {row.g: tuple(row)[1:] for row in with_metrics(totals, ["g"], metrics).collect()}
    big = float(sum(Fraction(10.0**k) for k in range(-9, 19, 3)))
    assert got == {1: (1.0, big, None, 10), 2: (2.0, big, None, 10)}


def test_partial_totals_merge_in_two_steps(spark):
    """As the summary does: totals of finer groups, of some layers each."""
    rng = random.Random(11)
    rows = [(i % 7, math.ldexp(rng.random(), rng.randrange(-60, 60))) for i in range(500)]
    frame = spark.createDataFrame(rows, "h int, x double").withColumn("g", F.lit(1))
    finer = with_parts(frame, ["x"]).groupBy("g", "h", LAYER).agg(*partial_totals(["x"]))
    merged = with_metrics(group_totals(finer, ["g"], ["x"]), [], METRICS).first()
    assert merged == total_of(spark, [x for _, x in rows], 2)
    usual = spark.createDataFrame([(1, h, x % 100) for h, x in rows], "g int, h int, x double")
    usual = usual.withColumn("x", F.round("x", 2))
    finer = with_parts(usual, ["x"]).groupBy("g", "h", LAYER).agg(*partial_totals(["x"]))
    outcomes = {with_metrics(group_totals(finer, ["g"], ["x"], limbs), [], METRICS).first() for limbs in (True, False)}
    assert len(outcomes) == 1
