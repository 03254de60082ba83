from __future__ import annotations

import heapq
import random
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from llm_support import ODD, frame, rows_of
from waybill.llm import mixing


def by_sql(docs):
    with duckdb.connect() as connection:
        connection.register("documents", docs.select("doc_id", "text", "source").toArrow())
        found = connection.execute(mixing.SQL)
        names = [column[0] for column in found.description]
        rows = found.fetchall()
    return names, sorted(rows, key=lambda row: [(v is not None, v) for v in row])


def test_mix_equals_sql(documents):
    names, rows = by_sql(documents)
    assert rows_of(mixing.mix(documents), *names) == rows


def test_odd_documents_equal_sql(odd):
    names, rows = by_sql(odd)
    assert rows_of(mixing.mix(odd), *names) == rows
    assert len(rows) == len(ODD)


@pytest.mark.parametrize("seed", range(3))
def test_small_sources_beside_a_large_one_equal_sql(spark, seed):
    draw = random.Random(seed)
    rows = [(i, "word " * draw.randint(1, 900), "en", "large") for i in range(120)]
    rows += [(1000 + i, "few words " * draw.randint(1, 9), "en", f"small{i % 6}") for i in range(20)]
    rows += [(2000 + i, draw.choice(["", None, "  \n"]), "en", draw.choice(["large", "empty"])) for i in range(40)]
    docs = frame(spark, rows)
    names, want = by_sql(docs)
    assert rows_of(mixing.mix(docs), *names) == want
    taken, target = Counter(), {}
    for row in mixing.mix(docs).collect():
        taken[row.source] += row.taken
        target[row.source] = row.target
    for source, goal in target.items():
        assert taken[source] == pytest.approx(goal, abs=1 + 0.02 * goal)


def test_documents_without_a_word_are_not_ranked(spark, tmp_path):
    rows = [(i, "", "en", "a") for i in range(3000)] + [(5000, "some words", "en", "a")]
    frame(spark, rows).write.parquet(f"{tmp_path}/docs")
    found = mixing.mix(spark.read.parquet(f"{tmp_path}/docs"))
    tasks = Counter(r.task for r in found.selectExpr("*", "spark_partition_id() AS task").collect())
    assert sum(tasks.values()) == 3001
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "(mix_size" in text and text.count("Union") >= 1


def test_no_documents_and_no_words(spark, none, odd):
    assert rows_of(mixing.mix(none)) == []
    wordless = odd.filter("doc_id IN (1, 2, 8)")
    assert [tuple(r)[2:] for r in mixing.mix(wordless).collect()] == [(0, 0, 0.0, 0)] * 3


def capped(sizes, weights, limit=3):
    """Targets by sharing the excess again and again, in fractions."""
    targets, left, open_ = {}, Fraction(sum(sizes)), set(range(len(sizes)))
    while open_:
        each = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = {i for i in open_ if each[i] > limit * sizes[i]}
        if not over:
            return {**targets, **each}
        for i in over:
            targets[i] = Fraction(limit * sizes[i])
            left -= targets[i]
        open_ -= over
    return targets


def sainte_lague(votes, seats):
    quota = [0] * len(votes)
    heap = [(-Fraction(v), i) for i, v in enumerate(votes) if v > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, i = heapq.heappop(heap)
        quota[i] += 1
        heapq.heappush(heap, (-Fraction(votes[i]) / (2 * quota[i] + 1), i))
    return quota


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_sharing_again(spark, seed):
    draw = random.Random(seed)
    sizes = [draw.choice([0, 1, 5, 40, 1000, 90_000]) * draw.randint(1, 9) for _ in range(9)]
    rows = [(f"s{i}" if i < 8 else None, n) for i, n in enumerate(sizes)]
    found = mixing.source_targets(spark.createDataFrame(rows, "mix_source string, mix_size long"))
    got = {r.mix_source: r.target for r in found.collect()}
    want = capped(sizes, [(5, 2, 1)[i % 3] for i in range(9)])
    for i, (name, _) in enumerate(rows):
        assert got[name] == pytest.approx(float(want[i]))
    assert sum(got.values()) == pytest.approx(sum(sizes))


@pytest.mark.parametrize("seed", range(4))
def test_apportionment_equals_seat_by_seat(spark, seed):
    draw = random.Random(seed)
    groups = {g: [draw.choice([0, 1, 7, 500]) * draw.randint(1, 99) for _ in range(6)] for g in "abc"}
    seats = {"a": 0, "b": 7, "c": 1000}
    rows = [(g, i, float(v), seats[g]) for g, votes in groups.items() for i, v in enumerate(votes)]
    parties = spark.createDataFrame(rows, "g string, i int, votes double, seats long")
    found = mixing.apportion(parties, [F.col("g")], "votes", "seats", F.col("i")).collect()
    got = {(r.g, r.i): r.quota for r in found}
    for g, votes in groups.items():
        assert [got[g, i] for i in range(6)] == sainte_lague(votes, seats[g])


@pytest.mark.parametrize("ranges", [1, 3, 4096])
def test_apportionment_by_ranges_of_quotients(spark, ranges, monkeypatch):
    monkeypatch.setattr(mixing, "RANGES", ranges)
    draw = random.Random(ranges)
    groups = {
        "alike": ([1000] * 150, 225),
        "mixed": ([draw.choice([3, 1000, draw.randint(1, 5000)]) for _ in range(200)], 1234),
        "few": ([draw.randint(1, 5000) for _ in range(100)], 7),
        "one": ([5], 9),
        "none": ([0, 0], 3),
    }
    rows = [(g, i, v, n) for g, (votes, n) in groups.items() for i, v in enumerate(votes)]
    parties = spark.createDataFrame(rows, "g string, i int, votes long, seats long")
    found = mixing.apportion(parties, [F.col("g")], "votes", "seats", F.col("i")).collect()
    got = {(r.g, r.i): r.quota for r in found}
    for g, (votes, n) in groups.items():
        assert [got[g, i] for i in range(len(votes))] == sainte_lague(votes, n)


def below(node):
    """The nodes of a finished adaptive plan that are directly below."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return [node.executedPlan()]
    if "QueryStage" in node.nodeName():
        return [node.plan()]
    return [node.children().apply(i) for i in range(node.children().size())]


def rows_into(window):
    """The rows that the nearest filter, join or exchange below let through."""
    node = window
    while True:
        (node,) = below(node)
        for name in ("numOutputRows", "shuffleRecordsWritten"):
            if node.metrics().contains(name):
                return node.metrics().apply(name).value()


def test_no_window_takes_all_shards_of_a_source(spark):
    draw = F.pmod(F.xxhash64("id"), F.lit(4000)) + 1
    parties = spark.range(100_000).select(
        F.when(F.col("id") >= 0, "hot").alias("g"), F.col("id").alias("i"), draw.alias("votes"), F.lit(150_000).alias("seats")
    )
    found = mixing.apportion(parties, [F.col("g")], "votes", "seats", F.col("i"))
    counted = found.select(F.sum("quota").alias("quota"))
    plan = counted._jdf.queryExecution().executedPlan()
    assert plan.executeCollect()[0].getLong(0) == 150_000
    windows, waiting = [], [plan]
    while waiting:
        node = waiting.pop()
        waiting += below(node)
        if node.nodeName() == "Window":
            windows.append(rows_into(node))
    assert windows and all(0 < rows < 10_000 for rows in windows)


def test_sources_come_near_their_targets(documents):
    rows = mixing.mix(documents).collect()
    taken, target = Counter(), {}
    for row in rows:
        assert 0 <= row.taken <= 3 * row.size
        taken[row.source] += row.taken
        target[row.source] = row.target
    for source, words in taken.items():
        assert words == pytest.approx(target[source], rel=0.02)


def test_reruns_agree_whatever_the_order(documents):
    first = rows_of(mixing.mix(documents))
    assert rows_of(mixing.mix(documents.repartition(5, "lang"))) == first


def test_many_shards(documents, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    sized = mixing.sized(documents).cache()
    quotas = mixing.shard_quotas(sized, shard_words=500)
    taken, goal = Counter(), {}
    for row in mixing.take(sized, quotas).collect():
        taken[row.mix_source, row.shard] += row.taken
    for row in quotas.collect():
        goal[row.mix_source, row.shard] = row.goal
    assert len(goal) > 60 and taken == Counter(goal) - Counter()


def words_of(text):
    return len(text.encode().split())


def test_rows_of_the_mix(documents, odd):
    for docs in (documents, odd):
        taken = Counter()
        for row in mixing.mix(docs).collect():
            taken[row.doc_id] += row.taken
        rows = mixing.mixed_documents(docs)
        assert rows.columns == docs.columns
        assert rows.dtypes == docs.dtypes
        got, texts = Counter(), defaultdict(set)
        for row in docs.collect():
            texts[row.doc_id].add(row.text or "")
        for row in rows.collect():
            got[row.doc_id] += words_of(row.text)
            assert any(text.startswith(row.text) for text in texts[row.doc_id])
            assert row.n_chars == len(row.text)
        assert got == taken - Counter()


def test_frame_has_clashing_columns(spark):
    assert "size" in frame(spark, ODD).columns


def test_small_sources_meet_their_targets_in_words(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAST_BLOCKS", 1)
    sizes = {"hot": 400_000, "tiny1": 3, "tiny2": 40, "tiny3": 170, "tiny4": 400, "tiny5": 5000}
    rows = [
        (i, " ".join(["word"] * min(1000, size - start)), "en", source)
        for source, size in sizes.items()
        for i, start in enumerate(range(0, size, 1000))
    ]
    taken, target = Counter(), {}
    for row in mixing.mix(frame(spark, rows)).collect():
        assert 0 <= row.taken <= 3 * row.size
        taken[row.source] += row.taken
        target[row.source] = row.target
    assert {source: target[source] for source in sizes if source != "hot"} == {
        source: 3.0 * size for source, size in sizes.items() if source != "hot"
    }
    for source in sizes:
        off = 512 + 1 if source == "hot" else 0.5
        assert abs(taken[source] - target[source]) <= off


def test_a_small_target_over_many_shards_is_met_in_words(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAST_BLOCKS", 1)
    rows = [("big", i, 90 + i % 20, f"{i * 7919 % 65536:015x}") for i in range(600)]
    rows += [(f"s{i:03}", i, 1000, f"{i:015x}") for i in range(200)]
    sized = spark.createDataFrame(
        rows, "mix_source string, mix_id long, mix_size long, mix_place string"
    )
    quotas = mixing.shard_quotas(sized, block_words=1024, shard_words=500)
    goals = Counter()
    target = {}
    for row in quotas.collect():
        assert row.goal <= 3 * row.shard_size
        goals[row.mix_source] += row.goal
        target[row.mix_source] = row.target
    assert target["big"] < 3000  # words, three blocks for more than a hundred shards
    for source, words in target.items():
        assert abs(goals[source] - words) <= 0.5
