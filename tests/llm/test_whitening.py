"""Whitening against numpy's eigenvectors and exact sums."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from waybill.llm.whitening import Centre, cholesky, components, jacobi, whiten

SCHEMA = "vec_id long, embedding array<double>, label int, x long, n string, component int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "n", 2) for i, v in rows], SCHEMA)


def whole(value):
    return math.floor(64 * float(value)) + 1_000_000


def brute(rows, most=16):
    """{row number: (n, deviation, [(whitened, explained)])}; signs as numpy has them."""
    usable = {
        k: tuple(map(whole, v))
        for k, (_, v) in enumerate(rows)
        if v and all(c is not None and math.isfinite(c) for c in v)
    }
    lengths = [len(v) for v in set(usable.values())]
    size = max(set(lengths), key=lambda s: (lengths.count(s), s))
    usable = {k: v for k, v in usable.items() if len(v) == size}
    fit = sorted(set(usable.values()))
    n, sums = len(fit), [sum(column) for column in zip(*fit)]

    def centred(v):
        return np.array([float(c - Fraction(s, n)) for c, s in zip(v, sums)])

    z = np.array([centred(v) for v in fit])
    covariance = z.T @ z / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    held = [i for i in range(min(most, size)) if values[i] > 1e-9 * values[0]]
    return {
        k: (
            n,
            sum((n * c - s) ** 2 for c, s in zip(v, sums)),
            [
                (float(centred(v) @ vectors[:, i] / math.sqrt(values[i])), values[i] / values.sum())
                for i in held
            ],
        )
        for k, v in usable.items()
    }


def check(spark, rows):
    """Compare as sorted rows, with each component's sign settled by its largest entry."""
    want = brute(rows)
    got = whiten(table(spark, rows)).collect()
    found = {}
    for row in got:
        found.setdefault(row.component, []).append(row)
    count = len(next(iter(want.values()))[2])
    assert sorted(found) == [*range(1, count + 1)]
    for component, mine in found.items():
        a = [(rows[k][0], n, dev, *each[component - 1]) for k, (n, dev, each) in want.items()]
        b = [(r.vec_id, r.n, r.deviation, r.whitened, r.explained) for r in mine]
        largest = max(a, key=lambda row: abs(row[3]))
        same = [row for row in b if row[0] == largest[0] and abs(abs(row[3]) - abs(largest[3])) < 1e-6]
        sign = math.copysign(1, same[0][3] * largest[3])
        key = lambda row: (row[0] is not None, row[0] or 0, round(row[3], 6))
        a = sorted(((i, n, d, w * sign, e) for i, n, d, w, e in a), key=key)
        for one, two in zip(a, sorted(b, key=key), strict=True):
            assert one[:3] == two[:3]
            assert two[3:] == pytest.approx(one[3:], rel=1e-6, abs=1e-7)
    assert len({row.identity_error for row in got}) == 1
    assert got[0].identity_error < 1e-6


@pytest.mark.parametrize("seed", range(3))
def test_equals_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    size = (3, 20, 33)[seed]
    vectors = rng.normal(size=(150, size)) * np.exp(-np.arange(size) / 4)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    check(spark, rows + rows[:40])


def test_test_table(spark, sf_dir):
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(row.vec_id, row.embedding) for row in embeddings.collect()]
    want, got = brute(rows), whiten(embeddings).collect()
    assert len(got) == 16 * len(want)
    place = {i: k for k, (i, _) in enumerate(rows)}
    matrix = {(row.vec_id, row.component): row for row in got}
    for component in range(1, 17):
        mine = [matrix[i, component] for i, _ in rows]
        theirs = [want[place[i]][2][component - 1] for i, _ in rows]
        dots = sum(a.whitened * b for a, (b, _) in zip(mine, theirs))
        for a, (b, share) in zip(mine, theirs):
            assert a.whitened == pytest.approx(math.copysign(b, b * dots), abs=1e-6)
            assert a.explained == pytest.approx(share, rel=1e-9)
            assert (a.n, a.deviation) == want[place[a.vec_id]][:2]
    assert got[0].identity_error < 1e-10


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(30, 4)))]
    odd = [
        (100, None), (101, []), (102, [1.0, None, 0.0, 0.0]), (103, [math.nan, 0.0, 0.0, 0.0]),
        (104, [math.inf, 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [0.0] * 4), (None, [0.5, 0.1, 0.2, 9.0]),
        (0, [3.0, 1.0, 1.0, 1.0]), (None, None),
    ]
    # A third of the rows is one vector: it is fitted once.
    copies = [(200 + i, [0.25, 0.5, -0.5, 0.125]) for i in range(20)]
    check(spark, good + odd + copies)


def test_dependent_dimensions_and_no_variance(spark):
    rng = np.random.default_rng(6)
    base = np.round(rng.normal(size=(40, 2)) * 8)
    rows = [(i, [a, b, a + b, a - b, 1.0]) for i, (a, b) in enumerate(base.tolist())]
    check(spark, rows)
    for few in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, None)]):
        assert whiten(table(spark, few)).collect() == []


def test_large_entries(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (v * 1e9).tolist()) for i, v in enumerate(rng.normal(size=(30, 3)))]
    got = whiten(table(spark, rows)).collect()
    want = brute(rows)
    for row in got:
        deviation = want[row.vec_id][1]
        assert row.deviation == (deviation if deviation < 1 << 63 else None)
    rows += [(99, [1e300, -1e300, 0.0])]
    assert len(whiten(table(spark, rows)).collect()) == 3 * 31


def test_deviations_around_the_end_of_longs():
    top = math.isqrt((1 << 63) - 1)
    centre = Centre(1, (0,))
    x = np.array([[top - 1], [top], [top + 1], [-top], [5]])
    assert centre.deviations(x) == [(top - 1) ** 2, top**2, None, top**2, 25]


def test_factors():
    rng = np.random.default_rng(9)
    half = rng.normal(size=(12, 7))
    matrix = half @ half.T
    factor = cholesky(matrix)
    assert factor.shape[1] == 7
    assert factor @ factor.T == pytest.approx(matrix, abs=1e-12)
    turned = jacobi(factor)
    products = turned.T @ turned
    assert np.abs(products - np.diag(np.diagonal(products))).max() < 1e-12
    assert turned @ turned.T == pytest.approx(matrix, abs=1e-12)
    vectors, values = components(matrix, 3)
    assert values == pytest.approx(np.linalg.eigvalsh(matrix)[::-1][:3])
    assert vectors.T @ vectors == pytest.approx(np.eye(3), abs=1e-13)


def test_small_eigenvalues_keep_their_digits():
    scales = 10.0 ** -np.arange(6)
    matrix = np.diag(scales**2)[::-1, ::-1]
    _, values = components(matrix, 6)
    assert values == pytest.approx(scales**2, rel=1e-14)
