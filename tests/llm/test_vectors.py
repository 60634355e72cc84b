"""Operators 11 and 12 against plain numpy and plain Python."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from genenet_spark.llm import centroids, queries, vectors, whitening

NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    """Rows with extra columns that bear the operators' own names."""
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, x string, cluster int")


def test_limbs():
    values = [0, 1, -1, 2**62, -(2**63), 2**100 + 7, -(2**126) - 5]
    assert [vectors.from_limbs(v) for v in zip(*vectors.to_limbs(values))] == values


# -- 11: whitening -----------------------------------------------------------------


def plain_whitening(rows, components=4):
    """The contract in dense algebra; ``rows`` are valid ``(id, vector)`` of one length."""
    xs = [(i, [math.floor(256 * c) for c in v]) for i, v in rows]
    fitted = np.array(sorted({tuple(x) for _, x in xs}), dtype=object)
    n, total = len(fitted), [int(s) for s in fitted.sum(axis=0)]
    mean = np.array([float(Fraction(s, n)) for s in total])
    centred = fitted.astype(float) - mean
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    out = {}
    for i, x in xs:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, total))
        w = (np.array(x, float) - mean) @ axes[:, :components] / np.sqrt(np.maximum(values[:components], 1e-300))
        out[i] = (n, deviation, w)
    return out, values


def check_whitening(out, expected, values, components=4):
    signs = {}
    assert sorted((r.vec_id, r.component) for r in out) == sorted((i, c + 1) for i in expected for c in range(components))
    for r in sorted(out, key=lambda r: -abs(r.whitened)):
        n, deviation, w = expected[r.vec_id]
        true = w[r.component - 1]
        sign = signs.setdefault(r.component, 1 if true * r.whitened > 0 else -1)
        assert r.n == n and r.deviation_exact == deviation and r.deviation == (deviation if deviation < 2**63 else None)
        assert abs(sign * r.whitened - true) <= 1e-7 * max(1, abs(true))
        assert abs(r.explained - values[r.component - 1] / values.sum()) <= 1e-9
        assert r.identity_error <= 1e-9


def test_whitening_of_the_table(spark, sf0001):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf0001}/embeddings.parquet").collect()]
    expected, values = plain_whitening(rows)
    check_whitening(queries.op11_whitening(spark, sf0001).collect(), expected, values)


def test_whitening_needs_the_filter(spark):
    """A slowly falling spectrum in 40 dimensions, sixteen columns a block."""
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    x = rng.standard_normal((700, 40)) * np.linspace(9, 3, 40) @ turn
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[i].tolist()) for i in range(50)]  # repeats are fitted once
    expected, values = plain_whitening(rows)
    check_whitening(whitening.whiten(frame(spark, rows).repartition(7)).collect(), expected, values)


def test_whitening_drops_and_degenerate_tables(spark):
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [NAN, 0.0, 0.0]), (93, [0.0, INF, 0.0]), (94, []), (95, [1.0])]
    rows = [(0, [1.0, 2.0, 3.0]), (1, [1.5, 0.0, -3.0]), (2, [-1.0, 2.0, 0.25]), (3, [-0.001, 9.0, 3.0]), (3, [-0.001, 9.0, 3.0]), (4, [7.0, 1.0, 1.0])]
    expected, values = plain_whitening(rows)
    out = whitening.whiten(frame(spark, rows + bad)).collect()
    assert sum(r.vec_id == 3 for r in out) == 6
    check_whitening([r for r in out if r.vec_id != 3] + [r for r in out if r.vec_id == 3][:3], expected, values, 3)
    equal = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in equal] == [(1, 0, None, 0.0)] * 4
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i]) for i in range(9)])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line) and max(abs(r.explained - 1) for r in line if r.component == 1) < 1e-12
    assert whitening.whiten(frame(spark, bad[:5])).collect() == [] and whitening.whiten(frame(spark, [])).collect() == []


def test_whitening_of_large_entries(spark):
    """Entries whose squares leave 64 bits: the sums stay exact."""
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(3) * [1e12, 1e11, 1e9]).tolist()) for i in range(60)]
    expected, values = plain_whitening(rows)
    out = whitening.whiten(frame(spark, rows)).collect()
    for r in out:
        assert r.n == expected[r.vec_id][0] and r.deviation is None and r.deviation_exact == expected[r.vec_id][1]
        assert abs(abs(r.whitened) - abs(expected[r.vec_id][2][r.component - 1])) < 1e-4


# -- 12: centroids -----------------------------------------------------------------


def plain_clusters(rows, count=16, rounds=3):
    xs = [(i, [math.floor(64 * c) for c in v]) for i, v in rows]
    first = sorted(xs, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    cs = [x for _, x in first[:count]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(cs))
    for _ in range(rounds):
        mine = [[] for _ in cs]
        for _, x in xs:
            mine[near(x)[1]].append(x)
        cs = [[sum(col) // len(m) for col in zip(*m)] if m else c for m, c in zip(mine, cs)]
    found = [(i, *near(x)[::-1]) for i, x in xs]
    inertia = {}
    for _, k, d in found:
        inertia[k] = inertia.get(k, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), digest[k]) for i, k, d in found), key=str)


def test_clusters_of_the_table(spark, sf0001):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf0001}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries.op12_centroids(spark, sf0001).collect()), key=str) == plain_clusters(rows)


def test_clusters_with_ties_repeats_and_bad_rows(spark):
    rng = np.random.default_rng(9)
    grid = [(i, rng.integers(-1, 2, 64).astype(float).tolist()) for i in range(120)]
    rows = grid + [(200 + i, grid[7][1]) for i in range(40)] + [(300, grid[3][1]), (300, grid[4][1]), (None, grid[5][1])]
    bad = [(400, None), (401, [1.0] * 63), (402, [1.0] * 65), (403, [NAN] + [1.0] * 63), (404, [None] + [1.0] * 63), (405, [INF] + [1.0] * 63), (406, [])]
    assert sorted(map(tuple, centroids.cluster(frame(spark, rows + bad).repartition(5)).collect()), key=str) == plain_clusters(rows)
    few = [(i, [float(i % 2)] * 64) for i in range(5)]  # fewer vectors than centroids, equal centroids
    assert sorted(map(tuple, centroids.cluster(frame(spark, few)).collect()), key=str) == plain_clusters(few)
    assert centroids.cluster(frame(spark, bad)).collect() == [] and centroids.cluster(frame(spark, [])).collect() == []


def test_distances_beyond_longs(spark):
    rows = [(i, [float(10 ** (9 + i % 5) * (-1) ** i)] * 64) for i in range(40)]
    out = sorted(map(tuple, centroids.cluster(frame(spark, rows)).collect()), key=str)
    fits = lambda v: v if v < 2**63 else None
    assert out == sorted(((i, k, fits(d), fits(a), fits(b), h) for i, k, d, a, b, h in plain_clusters(rows)), key=str)


def test_ptolemaic_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    middles = rng.integers(-400, 400, (16, 64))
    x = middles[rng.integers(0, 16, 3000)] + rng.integers(-40, 40, (3000, 64))
    cs = middles.tolist()
    pivots = centroids.choose_pivots(cs)
    far = np.stack([np.sqrt(((x - np.array(p)) ** 2).sum(axis=1)) for p in pivots])
    assigner = centroids.Assigner(cs, pivots)
    true = ((x[:, None, :] - middles[None]) ** 2).sum(axis=2)
    assert (assigner.bounds(far) <= np.sqrt(true)).all()
    cluster, best = assigner.nearest(x.astype(np.int64), far)
    assert (cluster == true.argmin(axis=1)).all() and (best == true.min(axis=1)).all()
    assert assigner.measured < 0.5 * true.size  # most distances were never computed


@pytest.mark.parametrize("points", [[], [[1, 2]], [[1, 2], [1, 2]], [[0, 0], [5, 0], [9, 0], [9, 0]]])
def test_pivots_differ(points):
    chosen = centroids.choose_pivots(points)
    assert len({tuple(p) for p in chosen}) == len(chosen) == len({tuple(p) for p in points})
