"""The whole summary: every trip, valid or not, and every measure in every slice."""

from __future__ import annotations

from datetime import datetime

import pytest

import __spark_entry__ as contract
import oracle_check
import trip_rows
from waybill.functions.exact import round_total
from waybill.operators.normalize import normalize
from waybill.plans import summary
from waybill.plans.metrics import LIMBS, ROWS, group_totals

LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_linestatus string,"
    " l_shipdate timestamp_ntz"
)
DAY = datetime(1998, 6, 2)
# Valid; no time, so no speed; a placeholder and no rate code; no distance; an amount too large
# for layer 0.
CASES = [
    (1, 101, 5, 1, 10.0, 100.25, 0.05, 0.02, "F", DAY),
    (2, 107, 5, 2, 11.0, 200.5, 0.06, 0.03, "F", DAY),
    (3, 101, 6, 3, 50.0, 300.75, 0.07, 0.04, "F", DAY),
    (4, 101, 6, 4, 48.0, 400.0, 0.08, 0.05, "O", DAY),
    (5, 100, 7, 5, 12.0, 500.25, 0.09, 0.06, "O", DAY),
    (6, 101, 7, 7, 13.0, 5_000_000.25, 0.1, 0.07, "O", DAY),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lines"))
    spark.createDataFrame(CASES, LINES).write.parquet(f"{base}/lineitem.parquet")
    return base


def test_all_trips_and_measures_are_in_every_slice(spark):
    cases = ({}, {"minutes": 0}, {"RatecodeID": 99}, {"RatecodeID": None}, {"minutes": -5})
    green = normalize(trip_rows.raw(spark, *cases), "green")
    rows = summary.summarize({"green": green}, reports=None).collect()
    for name in summary.SLICES:
        mine = [row for row in rows if row.slice == name]
        assert sum(row.trip_rows for row in mine) == 5
        assert sum(row.trip_rows for row in mine if not row.valid) == 4
        for measure in summary.MEASURES:
            shown = 4 if measure == "avg_speed_mph" else 5
            assert sum(row[f"{measure}_n"] for row in mine) == shown


def test_an_implausible_speed_loses_no_amount(spark):
    """It is too large for layer 0, and the other amounts of its row go with it."""
    green = normalize(trip_rows.raw(spark, {}, {"trip_distance": 1e9}), "green")
    totals = summary.summarize({"green": green}, reports=None)
    groups = group_totals(totals, ["slice"], summary.MEASURES)
    shown = round_total("total_amount", "1", LIMBS, 9).alias("total_amount")
    assert [tuple(row) for row in groups.select(ROWS, shown).collect()] == [(2, 40.0)] * 4


def test_the_query_shows_every_trip_and_measure_in_every_slice(spark, folder):
    rows = contract.queries()["trip_summary"](spark, folder).collect()
    assert {row.slice for row in rows} == set(summary.SLICES)
    for name in summary.SLICES:
        mine = [row for row in rows if row.slice == name]
        assert sum(row.trip_rows for row in mine) == len(CASES)
        assert {row.valid for row in mine} == {True, False}
        assert sum(row.total_amount for row in mine) == sum(case[5] for case in CASES)
        assert sum(row.fare_amount for row in mine) == sum(case[4] for case in CASES)
        assert sum(row.tip_amount for row in mine) == pytest.approx(45)
        assert sum(row.tolls_amount for row in mine) == pytest.approx(27)
        assert sum(row.trip_distance for row in mine if row.trip_distance_n) == 122.0
        assert sum(row.trip_distance_n for row in mine) == 5
        assert sum(row.trip_duration_min_n for row in mine) == len(CASES)
        assert sum(row.congestion_surcharge_n for row in mine) == len(CASES)
        assert sum(row.avg_speed_mph_n for row in mine) == 4


def test_the_query_equals_its_statement_on_these_rows(spark, sf_dir, folder):
    with oracle_check.connect(sf_dir) as connection:
        connection.execute(
            "CREATE OR REPLACE VIEW lineitem AS"
            f" SELECT * FROM read_parquet('{folder}/lineitem.parquet/*.parquet')"
        )
        frame = contract.queries()["trip_summary"](spark, folder)
        assert oracle_check.differences(frame, connection, contract.oracle_sql()["trip_summary"]) == []
