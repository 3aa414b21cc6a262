"""Centroid clustering against plain Lloyd rounds, and its planar bounds against sampled points."""

import math
from hashlib import sha256

import numpy as np
import pytest

from rankforge.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, cluster string, v int"


def plain(rows, dims, k, rounds, scale=64.0):
    """Exact rounds in Python integers: {row number: (cluster, distance)}, centroids."""
    kept = {}
    for n, (i, x) in enumerate(rows):
        if x is not None and len(x) == dims and all(e is not None and math.isfinite(e) for e in x):
            kept[n] = (i, [math.floor(scale * e) for e in x])
    order = sorted(kept, key=lambda n: sha256(f"1:{'null' if kept[n][0] is None else kept[n][0]}".encode()).hexdigest())
    cs = [kept[n][1] for n in order[:k]]

    def assign():
        return {n: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs)) for n, (_, v) in kept.items()}

    for _ in range(rounds):
        near = assign()
        for j in range(len(cs)):
            own = [kept[n][1] for n, (_, c) in near.items() if c == j]
            if own:
                cs[j] = [sum(col) // len(own) for col in zip(*own)]
    return {n: (j, d) for n, (d, j) in assign().items()}, cs


def check(spark, rows, dims, k=16, rounds=3):
    df = spark.createDataFrame([(i, x, "other", 7) for i, x in rows], SCHEMA).repartition(3)
    got = sorted((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                 for r in C.cluster(df, dims=dims, k=k, rounds=rounds).collect())
    near, cs = plain(rows, dims, k, rounds)
    inertia = {}
    for j, d in near.values():
        inertia[j] = inertia.get(j, 0) + d
    want = sorted((rows[n][0], j, d, inertia[j], sum(inertia.values()),
                   sha256(",".join(map(str, cs[j])).encode()).hexdigest()) for n, (j, d) in near.items())
    assert got == want
    return got


@pytest.mark.parametrize("spread", [0.05, 1.0, 1000.0])
def test_rounds_equal_plain_lloyd(spark, spread):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(9, 8))
    rows = [(i, (middles[i % 9] + spread * rng.normal(size=8)).tolist()) for i in range(700)]
    check(spark, rows, 8)


def test_nulls_lengths_ties_repeats_and_few_vectors(spark):
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.0]), (3, [0.5, 0.0]), (4, None), (5, [1.0]), (6, [None, 1.0]),
            (7, [float("nan"), 1.0]), (8, [float("inf"), 0.0]), (9, [1.0, 2.0, 3.0])]
    assert len(check(spark, rows, 2, k=2)) == 4
    assert len(check(spark, rows, 2, k=16)) == 4          # fewer vectors than centroids
    assert check(spark, [(10, [1e-3, -1e-3])] * 40, 2, k=3)  # all copies: later centroids stay empty
    assert check(spark, [(4, None)], 2) == []
    with pytest.raises(ValueError):
        C.cluster(spark.createDataFrame([(1, [2.0 ** 20] * 2, "", 0)], SCHEMA), dims=2, k=0)


def test_component_beyond_the_range_is_refused(spark):
    rows = [(1, [2.0 ** 20, 0.0], "", 0), (2, [0.0, 0.0], "", 0)]
    with pytest.raises(Exception, match="64 bits"):
        C.cluster(spark.createDataFrame(rows, SCHEMA), dims=2).collect()


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-2 ** 19, 2 ** 19, size=4) + rng.random(4)).tolist()) for i in range(60)]
    check(spark, rows, 4, k=4)


def test_every_bound_holds_and_is_below_the_drift():
    rng = np.random.default_rng(11)
    tighter = 0
    for _ in range(200):
        dims, k = int(rng.integers(2, 6)), 4
        old = rng.normal(size=(k, dims)) * 10
        new = old + rng.normal(size=(k, dims)) * rng.choice([0.01, 1.0, 5.0])
        radius = rng.random(k) * 6
        bound, drift = C.loosening(old, new, radius), C.drifts(old, new)
        for i in range(k):
            x = rng.normal(size=(400, dims))
            x = old[i] + x / np.linalg.norm(x, axis=1)[:, None] * radius[i] * rng.random((400, 1)) ** 0.2
            for j in range(k):
                gain = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
                assert gain.max() <= bound[i, j] + 1e-12
                assert bound[i, j] <= drift[j] * (1 + 1e-6) + 1e-6
                tighter += bound[i, j] < 0.9 * drift[j]
    assert tighter > 800


def test_most_vectors_of_clear_clusters_are_never_scanned_again(spark):
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(16, 64)) * 3
    df = spark.createDataFrame([(i, (middles[i % 16] + 0.1 * rng.normal(size=64)).tolist(), "", 0) for i in range(1600)], SCHEMA)
    _, done = C.fit(df)
    assert done.scanned[0] == done.rows == 1600 and sum(done.scanned[1:]) < 1600
    assert done.changed[0] == 1600
