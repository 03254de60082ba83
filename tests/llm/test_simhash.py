from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from llm_support import ODD, frame, rows_of
from waybill.llm import simhash


def plain_fingerprint(text, n=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(points, bits):
    """Smallest position reachable from each of ``points``."""
    parent = [*range(len(points))]

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if (int(points[i]) ^ int(points[j])).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


def clusters(seed, n=40, each=25, spread=4):
    """Fingerprints in dense clusters, so that links chain and cross boundaries."""
    draw, points = random.Random(seed), set()
    for _ in range(n):
        centre = draw.getrandbits(64)
        for _ in range(draw.randint(1, each)):
            near = centre
            for bit in draw.sample(range(64), draw.randint(0, spread)):
                near ^= 1 << bit
            points.add(near)
    return sorted(points)


@pytest.mark.parametrize("text", [t for _, t, _, _ in ODD] + ["One", "Ä B", "a b c d", "A b C\nd e f"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_long_texts_are_counted_in_parts(monkeypatch):
    monkeypatch.setattr(simhash, "_AT_ONCE", 100)
    text = " ".join(f"w{i * i % 977}" for i in range(1501))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("leaf", [8, 512])
def test_linking_in_a_shard(seed, leaf, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF_SIZE", leaf)
    points = clusters(seed)
    assert simhash.link(np.array(points, np.uint64), 2).tolist() == plain_groups(points, 2)


@pytest.mark.parametrize("seed", range(3))
def test_linked_pairs_meet_in_a_shard(seed):
    points = np.array(clusters(seed), np.uint64)
    tree = simhash.VantageTree(points[::3], 16)
    assert tree.leaves > 8
    shards = [set() for _ in points]
    for shard, at in tree.route(points, 2):
        for i in at:
            shards[i].add(shard)
    assert all(shards)
    for i in range(len(points)):
        near = np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 2)
        assert all(shards[i] & shards[j] for j in near)


@pytest.mark.parametrize("most", [4096, 5, 2])
@pytest.mark.parametrize("seed", range(2))
def test_edges_over_shards_give_all_components(spark, seed, most, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_SIZE", 40)
    monkeypatch.setattr(simhash, "MOST_SHARDS", most)
    points = clusters(seed)
    signed = np.array(points, np.uint64).view(np.int64).tolist()
    distinct = spark.createDataFrame([(b,) for b in signed], "bits long")
    roots = simhash.components(simhash.linked_edges(spark, distinct, 2))
    root = {b: b for b in signed} | {r.node: r.root for r in roots.collect()}
    place = {b: i for i, b in enumerate(signed)}
    want = plain_groups(points, 2)
    groups = {}
    for i, b in enumerate(signed):
        groups.setdefault(place[root[b]], set()).add(want[i])
    assert all(len(names) == 1 for names in groups.values())
    assert len(groups) == len(set(want))


def test_large_shards_are_dealt_again(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_SIZE", 64)
    points = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 3000, np.uint64))
    rows = [(int(i % 3), int(b)) for i, b in enumerate(points)]
    # One shard is too small for the sample of its tree.
    rows += [(3, 17)]
    dealt = spark.createDataFrame(rows, "shard int, bits long")
    found = simhash._dealt_again(dealt, 4, 2).collect()
    assert {(r.shard, r.bits) for r in found} == set(rows)
    sizes = Counter((r.shard, r.part) for r in found)
    assert len(sizes) > 20 and max(sizes.values()) < 500 and sizes[3, 0] == 1


def test_components_of_a_long_chain(spark):
    pairs = spark.range(1, 200).selectExpr("id AS a", "id - 1 AS b")
    rows = simhash.components(pairs).collect()
    assert {(r.node, r.root) for r in rows} == {(i, 0) for i in range(1, 200)}


def expected(documents):
    found = [plain_fingerprint(text) for _, text in documents]
    groups = plain_groups(found, 2)
    smallest = {}
    for (doc_id, _), group in zip(documents, groups):
        if doc_id is not None:
            smallest[group] = min(doc_id, smallest.get(group, doc_id))
    rows = [(i, f"{f:016x}", smallest.get(g)) for (i, _), f, g in zip(documents, found, groups)]
    return sorted(rows, key=lambda row: [(v is not None, v) for v in row]), len(set(groups))


def test_near_duplicates_equal_brute_force(documents):
    texts = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert rows_of(simhash.near_duplicates(documents)) == expected(texts)[0]


def test_odd_documents(spark, odd, none):
    rows, components = expected([d[:2] for d in ODD])
    assert rows_of(simhash.near_duplicates(odd)) == rows
    kept = simhash.without_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == components
    assert rows_of(simhash.near_duplicates(none)) == []
    assert rows_of(simhash.without_near_duplicates(none)) == []


def test_one_row_of_each_component_stays(spark, documents):
    named = rows_of(simhash.near_duplicates(documents))
    stays = simhash.without_near_duplicates(documents)
    assert [r[0] for r in rows_of(stays, "doc_id")] == sorted({r[2] for r in named})


def test_rows_without_an_id(spark):
    rows = [(None, "a b c d e", "en", "s"), (None, "a b c d e", "en", "s"), (None, "x y z", "en", "s")]
    docs = frame(spark, rows)
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {None}
    assert sorted(r.text for r in simhash.without_near_duplicates(docs).collect()) == ["a b c d e", "x y z"]
