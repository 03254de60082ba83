from __future__ import annotations

import duckdb

from llm_support import LINE, ODD, frame, rows_of
from waybill.llm import line_dedup


def by_sql(docs):
    with duckdb.connect() as connection:
        connection.register("documents", docs.select("doc_id", "text").toArrow())
        found = connection.execute(line_dedup.SQL)
        names = [column[0] for column in found.description]
        rows = found.fetchall()
    return names, sorted(rows, key=lambda row: [(v is not None, v) for v in row])


def test_report_equals_sql(documents):
    names, rows = by_sql(documents)
    assert rows_of(line_dedup.line_report(documents), *names) == rows


def test_odd_documents_equal_sql(odd, none):
    with_id = odd.filter("doc_id IS NOT NULL")
    names, rows = by_sql(with_id)
    got = rows_of(line_dedup.line_report(odd), *names)
    assert [row for row in got if row[0] is not None] == rows
    assert [row[2] for row in got if row[0] is None] == [0, 0]
    assert rows_of(line_dedup.line_report(none)) == []


def test_texts(spark, odd, documents):
    kept = line_dedup.without_shared_lines(odd)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    rows = {(r.doc_id, r.text): r for r in kept.collect()}
    assert len(kept.collect()) == len(ODD)
    assert (3, "but not this one\n") in rows
    assert (4, "") in rows and rows[4, ""].n_chars == 0
    assert (5, f"x\n{LINE}") in rows  # the largest id keeps the line
    assert (None, f"no id\n{LINE}") in rows
    assert (2, None) in rows


def test_repeats_of_the_kept_line_stay(spark):
    rows = [(i, f"{LINE}\n{LINE.upper()}\nown {i}", "en", "s") for i in (1, 2, 3)]
    texts = {r.doc_id: r.text for r in line_dedup.without_shared_lines(frame(spark, rows)).collect()}
    assert texts == {1: "own 1", 2: "own 2", 3: rows[2][1]}


def test_rows_of_one_id_count_once(spark):
    rows = [(1, LINE, "en", "s"), (1, LINE, "en", "s"), (2, LINE, "en", "s")]
    assert {r.n_dropped for r in line_dedup.line_report(frame(spark, rows)).collect()} == {0}


def test_short_keys_stay(spark):
    rows = [(i, "x" * 19 + " " * 5, "en", "s") for i in range(5)]
    assert {r.n_dropped for r in line_dedup.line_report(frame(spark, rows)).collect()} == {0}
    rows = [(i, "é" * 20, "en", "s") for i in range(5)]
    dropped = [r.n_dropped for r in line_dedup.line_report(frame(spark, rows)).collect()]
    assert sum(dropped) == 4
