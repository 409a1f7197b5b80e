"""Rounds with bounds against plain ones in Python's integers."""

import hashlib
import itertools
import math

import numpy as np
import pytest

from penprint.llm import pivot_kmeans as pk


def plain(rows, clusters, rounds):
    key = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    rows = sorted(rows, key=key)
    points = [[math.floor(pk.scaled(x)) for x in v] for _, v in rows]
    cents = points[:clusters]

    def place():
        return [min((pk.squared(p, c), k) for k, c in enumerate(cents)) for p in points]

    for _ in range(rounds):
        at = place()
        for k in range(len(cents)):
            own = [p for p, (_, j) in zip(points, at) if j == k]
            if own:
                cents[k] = [sum(x) // len(own) for x in zip(*own)]
    at, most = place(), (1 << 63) - 1
    total = {k: sum(min(d, most) for d, j in at if j == k) for k in range(len(cents))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(
        ((i, k, min(d, most), min(total[k], most), min(sum(total.values()), most), sha[k]) for (i, _), (d, k) in zip(rows, at)),
        key=str,
    )


def cases():
    rng = np.random.default_rng(5)
    near = [(i, rng.normal(0, 1, 4).round(2).tolist()) for i in range(200)]
    grid = [(i, [float(x) for x in p]) for i, p in enumerate(itertools.product((0, 1), repeat=4))]
    copies = [(7, [0.5, -0.5, 0.25, 0.0])] * 90 + [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(10)]
    huge = near[:40] + [(1000, [1e30, -1e30, 0.0, 3.0]), (1001, [2e5, 0.0, 0.0, 0.0]), (1002, [1e308, 1.0, 1.0, 1.0])]
    return [near, grid, copies, huge, near[:3], [(None, [1.0, 1.0, 1.0, 1.0])] * 2 + near[:20]]


@pytest.mark.parametrize("case", range(6))
def test_against_plain_rounds(spark, case):
    rows = cases()[case]
    bad = [(1, None), (2, [1.0] * 3), (3, [1.0, None, 1.0, 1.0]), (4, [float("nan")] * 4), (5, [float("inf")] * 4), (6, [])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows + bad], "vec_id long, embedding array<double>, cluster string")
    got = pk.clustered(frame.repartition(3), clusters=5, rounds=4, dims=4)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, 5, 4)


def test_no_vectors(spark):
    frame = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    got = pk.clustered(frame)
    assert got.count() == 0
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_bounds_hold_and_save_work():
    rng = np.random.default_rng(9)
    middles = rng.integers(-3000, 3000, (8, 16))
    values = (middles[rng.integers(0, 8, 3000)] + rng.integers(-300, 300, (3000, 16))).astype(np.int64)
    pivots = pk.spread_points(values[:64].tolist(), 6)
    to_pivots, of_middles = pk.distances_to(values, {}, pivots), pk.distances_to(middles, {}, pivots)
    gaps = np.array([[math.sqrt(pk.squared(p, q)) for q in pivots] for p in pivots])
    bounds = pk.lower_bounds(to_pivots, of_middles, gaps)
    exact = ((values[:, None] - middles[None]) ** 2).sum(axis=2)
    assert (bounds**2 <= exact).all()
    at, best, measured = pk.nearest(values, to_pivots, middles, of_middles, gaps)
    assert (best == exact.min(axis=1)).all() and (at == exact.argmin(axis=1)).all()
    assert measured < 0.6 * exact.size
