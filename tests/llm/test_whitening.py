"""Whitening against exact sums and a dense decomposition, and the contour method by itself."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotaflow.llm import feast, whitening
from quotaflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, n string, _k int, component double"


def frame(spark, vectors):
    rows = [(i, v, 1, "x", 2, 0.5) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA)


def plain(vectors, components=32):
    """(id, component) to (n, deviation, |whitened|, explained), by definition."""
    width = max((len(v) for _, v in vectors), default=0)
    usable = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in vectors]
    n = len(usable)
    sums = [sum(x[j] for _, x in usable) for j in range(width)]
    centred = [[Fraction(n * x[j] - sums[j], n) for j in range(width)] for _, x in usable]
    v = np.array([[float(sum(z[i] * z[j] for z in centred) / n) for j in range(width)] for i in range(width)])
    values, axes = np.linalg.eigh(v)
    top = [k for k in range(width)[::-1] if values[k] > 1e-9 * values[-1]][:components]
    out = []
    for (i, _), z in zip(usable, centred, strict=True):
        deviation = int(sum((c * n) ** 2 for c in z))
        for place, k in enumerate(top, 1):
            w = float(np.array([float(c) for c in z]) @ axes[:, k] / math.sqrt(values[k]))
            out.append((i, place, n, deviation, w, values[k] / np.trace(v)))
    return out


def same(found, wanted, signs=True):
    """All but the whitened values exactly in order, those by size, and one sign per component."""
    key = lambda r: (repr(r[0]), r[1], r[3], abs(r[4]))
    found, wanted = sorted(found, key=key), sorted(wanted, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in wanted]
    assert [r[4] for r in map(lambda r: (*r[:4], abs(r[4])), found)] == pytest.approx([abs(r[4]) for r in wanted], rel=1e-8, abs=1e-9)
    assert [r[5] for r in found] == pytest.approx([r[5] for r in wanted], rel=1e-10)
    turned = {}
    for f, w in zip(found, wanted, strict=True):
        if abs(w[4]) > 1e-6:
            assert turned.setdefault(f[1], f[4] * w[4] > 0) == (f[4] * w[4] > 0)


def ran(df):
    return [tuple(r) for r in df.drop("identity_error").collect()]


def test_whole_table(spark, sf_dir):
    found = QUERIES["op13_embedding_whitening"](spark, sf_dir)
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors = [(r[0], r[1]) for r in rows]
    same(ran(found), plain(vectors))
    errors = {r[0] for r in found.select("identity_error").distinct().collect()}
    assert len(errors) == 1 and errors.pop() < 1e-10


def vectors(seed=3, n=60, width=5):
    r = np.random.default_rng(seed)
    return [(i, [float(c) for c in row]) for i, row in enumerate(r.standard_normal((n, width)).astype(np.float32))]


def test_unusable_rows_are_left_out(spark):
    good = vectors() + [(7, [0.5] * 5), (7, [0.5] * 5), (None, [1.0, 2.0, -3.0, 0.0, 0.25])]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
           (104, []), (105, [1.0, 2.0]), (106, [3e38, 0.0, 0.0, 0.0, 0.0])]
    rows = frame(spark, good + bad)
    same(ran(whitening.whiten(rows, whitening.fit(rows))), plain(good))


def test_dealing_changes_nothing(spark):
    rows = frame(spark, vectors(n=200))
    fits = [whitening.fit(rows.repartition(k)) for k in (1, 7)]
    assert fits[0].sums == fits[1].sums
    assert np.array_equal(fits[0].values, fits[1].values) and np.array_equal(fits[0].components, fits[1].components)


@pytest.mark.parametrize("given", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [3.0, 4.0]) for i in range(9)]])
def test_nothing_to_whiten(spark, given):
    rows = frame(spark, given)
    assert whitening.whiten(rows, whitening.fit(rows)).count() == 0


def test_a_constant_dimension_has_no_component(spark):
    given = [(i, [*v, 1.0]) for i, v in vectors(width=3)]
    rows = frame(spark, given)
    found = whitening.whiten(rows, whitening.fit(rows))
    assert found.agg(F.max("component")).first()[0] == 3
    same(ran(found), plain(given))


def test_one_vector_for_a_third_of_the_rows(spark):
    given = vectors(n=100) + [(1000 + i, [0.1, 0.2, 0.3, 0.4, 0.5]) for i in range(50)]
    rows = frame(spark, given)
    same(ran(whitening.whiten(rows, whitening.fit(rows, 2))), plain(given, 2))


def test_sums_that_leave_floats():
    y = np.array([[1 << 40, -3], [(1 << 40) + 1, 5], [2, 7]])
    wanted = y.astype(object).T @ y.astype(object)
    assert (whitening.products(y) == wanted).all()


def test_deviation_beyond_64_bits():
    found = whitening.Whitening(1 << 40, [0, 0], np.ones(1), np.ones((1, 2)), 1.0)
    with pytest.raises(OverflowError):
        found.deviations(np.array([[1 << 20, 0]]))


MATRICES = {
    "ties": np.diag([5.0] * 10 + [3.0] * 15 + [1.0] * 7),
    "one value": np.eye(20) * 7,
    "low rank": np.diag([4.0, 2.0, 1.0] + [0.0] * 17),
    "geometric": np.diag(2.0 ** -np.arange(40)),
    "close": np.diag(1 + 1e-9 * np.arange(20)),
    "one": np.eye(1),
    "zero": np.zeros((4, 4)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_leading_eigenvectors(name):
    diagonal = MATRICES[name]
    size = len(diagonal)
    turn = np.linalg.qr(np.random.default_rng(2).standard_normal((size, size)))[0]
    matrix = turn @ diagonal @ turn.T
    matrix = (matrix + matrix.T) / 2
    values, axes = feast.leading(matrix, 12)
    top = float(diagonal.max())
    wanted = [v for v in sorted(np.diagonal(diagonal))[::-1] if v > 0][:12]
    assert values == pytest.approx(wanted, abs=1e-13 * max(top, 1))
    assert np.abs(axes @ axes.T - np.eye(len(axes))).max(initial=0) < 1e-13
    assert np.abs(matrix @ axes.T - axes.T * values).max(initial=0) <= 1e-12 * max(top, 1)


def test_inertia_counts():
    r = np.random.default_rng(4)
    for _ in range(100):
        size = int(r.integers(1, 25))
        a = r.standard_normal((size, size))
        a, shift = a + a.T, float(r.standard_normal())
        assert feast.count_below(a, shift) == (np.linalg.eigvalsh(a) < shift).sum()
    # No diagonal to start with: pivots of two.
    assert feast.count_below(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def test_intervals_hold_what_they_count():
    r = np.random.default_rng(6)
    z = r.standard_normal((300, 50))
    matrix = z.T @ z / 300
    values = np.linalg.eigvalsh(matrix)
    cuts = list(feast.intervals(matrix, 32, 1e-12, values[-1] * 1.1))
    assert sum(n for *_, n in cuts) >= 32
    assert all(((values > low) & (values < high)).sum() == n for low, high, n in cuts)


def test_mixed_values_inside_are_not_taken():
    """Many spectra with other eigenvalues close outside, which first give values inside without being one."""
    for seed in range(12):
        z = np.random.default_rng(seed).standard_normal((200, 64)) * 5
        matrix = z.T @ z / 200
        values, _ = feast.leading(matrix, 32)
        assert values == pytest.approx(np.linalg.eigvalsh(matrix)[::-1][:32], rel=1e-12)
