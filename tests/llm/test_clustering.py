"""Clustering against plain rounds over all centroids, and the bounds against points of the spheres."""

import hashlib

import numpy as np
import pytest

from tidemill.llm import clustering

SCHEMA = "vec_id long, embedding array<float>, cluster int, upper double, id string, point int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0, "x", 3) for i, v in rows], SCHEMA)


def plain(rows, k, rounds, dimensions):
    kept = [(i, [int(min(max(np.floor(64 * float(np.float32(x))), -2 ** 26), 2 ** 26)) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    seeds = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    centroids = [v for _, v in seeds]
    for n in range(rounds + 1):
        best = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]
        if n < rounds:
            for j in range(len(centroids)):
                own = [v for (_, v), (_, c) in zip(kept, best) if c == j]
                if own:
                    centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    each = {j: sum(d for d, c in best if c == j) for j in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, each[c], sum(each.values()), digest[c]) for (i, _), (d, c) in zip(kept, best)), key=str)


def found(spark, rows, k, rounds, dimensions):
    return sorted((tuple(r) for r in clustering.clusters(table(spark, rows).repartition(3), k, rounds, dimensions).collect()), key=str)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_against_plain_rounds(spark, spread):
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(9, 64))
    rows = [(i, (middle[rng.integers(9)] + spread * rng.normal(size=64)).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # a hot vector
    assert found(spark, rows, 16, 3, 64) == plain(rows, 16, 3, 64)


def test_odd_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, []), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 2.0, 3.0]), (8, [-1.0, -0.01]),
            (8, [-1.0, -0.01]), (8, [0.0, -0.0]), (None, [5.0, 5.0]), (9, [3e38, -3e38]), (10, [1.0, 2.0])]
    for k in (1, 2, 3, 20):
        assert found(spark, rows, k, 3, 2) == plain(rows, k, 3, 2)
    assert found(spark, [(1, [1.0])], 4, 3, 2) == [] and clustering.clusters(table(spark, [])).count() == 0


def test_ties_take_the_smaller_number(spark):
    rows = [(i, [float(i % 3 - 1), 0.0]) for i in range(30)]
    assert found(spark, rows, 5, 3, 2) == plain(rows, 5, 3, 2)


def test_loosening_bounds_every_gain_and_is_below_the_drift():
    rng = np.random.default_rng(5)
    for dimensions in (2, 3, 8):
        old = rng.normal(size=(12, dimensions)) * 10
        new = old + rng.normal(size=old.shape) * rng.choice([0.0, 0.1, 3.0], size=(12, 1))
        radius = rng.random(12) * 8
        bound = clustering.loosening(old, new, radius)
        drift = np.sqrt(((new - old) ** 2).sum(1))
        assert (bound <= drift[None, :] * (1 + 1e-6)).all() and (bound < 0.9 * drift[None, :])[:, drift > 0].mean() > 0.3
        for i in range(12):
            way = rng.normal(size=(3000, dimensions))
            inside = old[i] + radius[i] * way / np.sqrt((way ** 2).sum(1))[:, None] * rng.choice([1.0, 0.7], size=(3000, 1))
            gain = np.sqrt(((inside[:, None] - old[None]) ** 2).sum(2)) - np.sqrt(((inside[:, None] - new[None]) ** 2).sum(2))
            assert (gain.max(0) <= bound[i] + 1e-9).all()


def test_most_vectors_are_not_scanned():
    rng = np.random.default_rng(8)
    middle = rng.normal(size=(8, 64)) * 100
    point = (middle[rng.integers(8, size=2000)] + 5 * rng.normal(size=(2000, 64))).astype(np.int64)
    old = middle.astype(np.int64)
    new = old + rng.integers(-3, 4, size=old.shape)
    square = ((point[:, None] - old[None]) ** 2).sum(2).astype(float)
    near = np.sqrt(np.sort(square, 1))
    radius = np.array([near[square.argmin(1) == j, 0].max(initial=0) for j in range(8)])
    loose = clustering.loosening(old.astype(float), new.astype(float), radius)
    assert (near[:, 0] + 30 < near[:, 1] - loose[square.argmin(1)].max(1)).mean() > 0.9
