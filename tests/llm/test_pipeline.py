from __future__ import annotations

import sys

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
import oracle_check
from llm_support import rows_of
from waybill.llm import line_dedup, mixing, quality, queries, simhash
from waybill.llm.shared import staged


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage gets and gives, by its name."""
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, staged(stage(spark, docs, sf_dir), name)
        seen[name] = (given, docs)
    return seen


def test_stages_return_the_columns_of_documents(documents, stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == list(stages) and len(names) == 5
    for name in names[:-1]:
        assert stages[name][1].dtypes == documents.dtypes


def test_quality_stage(stages, labels):
    given, kept = stages["quality_rules"]
    wanted = quality.judge(given, labels).filter("kept").select("doc_id")
    assert rows_of(kept, "doc_id") == rows_of(wanted)
    assert 0 < kept.count() < given.count()
    assert rows_of(kept) == rows_of(given.join(wanted, "doc_id").select(given.columns))


def test_line_stage(stages):
    given, kept = stages["line_dedup"]
    with duckdb.connect() as connection:
        connection.register("documents", given.select("doc_id", "text").toArrow())
        connection.register("kept", kept.select("doc_id", "text").toArrow())
        different = connection.execute(
            f"SELECT count(*) FROM ({line_dedup.SQL}) JOIN kept USING (doc_id)"
            " WHERE sha256(coalesce(text, '')) <> kept_sha256"
        ).fetchone()
    assert different == (0,) and kept.count() == given.count()


def test_near_duplicate_stage(stages):
    given, kept = stages["simhash_near_dedup"]
    groups = {row[2] for row in rows_of(simhash.near_duplicates(given))}
    assert [row[0] for row in rows_of(kept, "doc_id")] == sorted(groups)


def test_mixing_stage(stages):
    given, kept = stages["source_mixing"]
    taken = {r.doc_id: r.taken for r in mixing.mix(given).collect() if r.taken}
    got = {}
    for row in kept.collect():
        got[row.doc_id] = got.get(row.doc_id, 0) + len(row.text.encode().split())
    assert got == taken


def test_packing_stage(stages):
    given, packed = stages["best_fit_packing"]
    rows = packed.collect()
    assert sum(r.piece == 0 for r in rows) == given.count()
    places = {}
    for row in rows:
        assert len(np.frombuffer(row.ids, "<u2")) == row.length
        places.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for placed in places.values():
        ends = np.cumsum([0, *(length for _, length in sorted(placed))])
        assert [offset for offset, _ in sorted(placed)] == ends[:-1].tolist() and ends[-1] <= 2048


def test_run_is_all_stages(spark, sf_dir, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, sf_dir)
    assert rows_of(got, *columns) == rows_of(stages["best_fit_packing"][1], *columns)


@pytest.mark.parametrize("key", queries.SQL)
def test_query_equals_statement(spark, sf_dir, key):
    with oracle_check.connect(sf_dir) as connection:
        frame = queries.QUERIES[key](spark, sf_dir)
        assert oracle_check.differences(frame, connection, queries.SQL[key]) == []


def test_every_operator_has_a_query():
    for n in range(1, 14):
        assert sum(key.startswith(f"op{n}_") for key in contract.queries()) == 1
    assert "pipeline" in contract.queries()


NATIVE = ("op2_mixing", "op5_quality", "op9_licenses")


@pytest.mark.parametrize("key", NATIVE)
def test_native_operators_run_no_python(spark, sf_dir, key, capsys):
    queries.QUERIES[key](spark, sf_dir).explain()
    text = capsys.readouterr().out
    for unwanted in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin"):
        assert unwanted not in text


@pytest.mark.parametrize("missing", ["corpus_pipeline", "waybill.llm.queries", "zstandard"])
def test_entry_without_the_subpackage_or_what_it_needs(monkeypatch, missing):
    """Deleted folders, and a library that is not installed, leave the other queries."""
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("waybill.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    for attribute in ("llm",):
        monkeypatch.delattr(sys.modules["waybill"], attribute, raising=False)
    assert contract.queries().keys() == contract.trip_queries().keys()
    assert contract.oracle_sql().keys() == contract.queries().keys()
