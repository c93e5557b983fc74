"""Whitening against dense linear algebra and exact integers."""

import math

import numpy as np
import pytest

from corvid.llm import whitening
from corvid.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, n long, `a.b` string"


def frame(spark, rows, parts=3):
    full = [(i, v, 1, 7, "x") for i, v in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def integers(vectors):
    return [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]


def brute(vectors, wanted=8):
    """(n, deviations, eigenvalues, projections up to sign, trace)."""
    x = integers(vectors)
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    deviations = [sum((n * r[j] - sums[j]) ** 2 for j in range(d)) for r in x]
    y = np.array([[(n * r[j] - sums[j]) / n for j in range(d)] for r in x])
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1][:wanted], v[:, ::-1][:, :wanted]
    return n, deviations, e, y @ v / np.sqrt(e), float((y * y).sum() / n)


def check(spark, rows, wanted=8, **options):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, deviations, e, projected, trace = brute([v for _, v in good], wanted)
    got = whitening.whiten(frame(spark, rows), wanted=wanted, **options).collect()
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    assert sorted(by) == list(range(1, len(e) + 1))
    for k, found in by.items():
        assert sorted((r["vec_id"], r["n"], r["deviation"]) for r in found) == \
            sorted((i, n, x) for (i, _), x in zip(good, deviations))
        want = {i: p for (i, _), p in zip(good, projected[:, k - 1])}
        sign = np.sign(sum(r["whitened"] * want[r["vec_id"]] for r in found))
        assert all(abs(sign * r["whitened"] - want[r["vec_id"]]) < 1e-8 for r in found)
        assert all(abs(r["explained"] / (e[k - 1] / trace) - 1) < 1e-10 for r in found)
        assert all(r["identity_error"] < 1e-9 for r in found)
        assert len({r["identity_error"] for r in found}) == 1


def vectors(n, d, seed=1):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, d)) @ (rng.normal(size=(d, d)) / 3)
    return [[float(np.float32(c)) for c in row] for row in mixed]


def test_against_dense_eigenproblem(spark):
    rows = list(enumerate(vectors(300, 12)))
    rows += [(i, rows[0][1]) for i in range(1000, 1200)]  # a very common vector
    rows += [(5000, None), (5001, [None] * 12), (5002, [float("nan")] + [0.0] * 11),
             (5003, [float("inf")] + [0.0] * 11), (5004, []), (5005, [1.0, 2.0])]
    check(spark, [r for r in rows if r[0] != 5005])
    got = whitening.whiten(frame(spark, rows))
    assert got.count() == 500 * 8 and not got.where("vec_id >= 5000").count()


def test_basis_cut_short_is_refined(spark):
    check(spark, list(enumerate(vectors(200, 20, 3))), wanted=3, rank=8)


def test_few_directions(spark):
    # two directions only: two components; no variance, one row, no row: none
    rows = [(i, [float(i), 2.0 * i, float(i % 3), 0.0]) for i in range(20)]
    assert sorted({r["component"] for r in whitening.whiten(frame(spark, rows)).collect()}) == [1, 2]
    for few in ([(1, [1.0, 2.0])] * 5, [(1, [3.0])], []):
        got = whitening.whiten(frame(spark, few))
        assert got.collect() == [] and len(got.columns) == 7


def test_repeated_and_null_ids_are_rows(spark):
    rows = [(None, v) for v in vectors(5, 3)] + [(7, v) for v in vectors(5, 3, 2)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 30 and sum(r["vec_id"] is None for r in got) == 15


def test_deviation_is_exact_or_null():
    centre = whitening.Centre(10 ** 6, [10 ** 11 + 1, 10 ** 11 + 10 ** 6 - 1])
    x = np.array([[100_000, 99_000], [200_000, 10 ** 12]])
    want = [sum((10 ** 6 * int(a) - s) ** 2 for a, s in zip(r, (10 ** 11 + 1, 10 ** 11 + 10 ** 6 - 1)))
            for r in x]
    assert centre.deviations(x) == [want[0], None] and want[1] >= 1 << 63


@pytest.mark.parametrize("rows", [
    [[1, 0, 0], [0, 1, 0], [0, 0, 1], [1, 1, 0], [1, 1, 0], [0, 0, 0], [2, 2, 2]],
    [[1, 1e-9, 0], [1, -1e-9, 0], [1, 0, 1e-12]],
    [[1e8, 1, 0], [1e8, 0, 1], [0, 1e-6, 1e8], [1e8, 1, 0]]])
def test_rank_one_updates(rows):
    own, parts = whitening.Spectrum(3), [whitening.Spectrum(3) for _ in range(2)]
    for i, y in enumerate(np.array(rows, float)):
        own.add(y)
        parts[i % 2].add(y)
    parts[0].merge(whitening.Spectrum.unpack(parts[1].pack(), 3))
    want = np.array(rows, float).T @ np.array(rows, float)
    for s in (own, parts[0]):
        assert np.abs(s.q.T @ s.q - np.eye(s.q.shape[1])).max() < 1e-12
        assert np.abs((s.q * s.d) @ s.q.T - want).max() <= 1e-13 * np.abs(want).max()


def test_secular_roots_interlace():
    rng = np.random.default_rng(4)
    for gap in (1.0, 1e-6, 1e-12):
        d = np.cumsum(rng.random(30) * gap + gap)
        z2 = rng.random(30) ** 8 + 1e-20
        diff, roots = whitening.secular_roots(d, z2)
        assert (np.diag(diff) < 0).all() and (diff[np.arange(29), np.arange(1, 30)] > 0).all()
        assert abs(roots.sum() - d.sum() - z2.sum()) < 1e-10 * (d.sum() + z2.sum())


def test_query(spark):
    got = QUERIES["op11_rank_one_whitening"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"]
    rows = got.collect()
    assert len(rows) == 8 * rows[0]["n"] and rows[0]["identity_error"] < 1e-9
