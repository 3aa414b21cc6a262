"""Voronoi kNN join against brute force."""

import numpy as np
import pytest

from rankforge.llm import knn

SCHEMA = "vec_id long, embedding array<float>, label int, v int"


def brute(rows, k=5, every=50):
    good = {}
    for i, x, *_ in rows:
        if i is None or x is None or any(c is None or not np.isfinite(c) for c in x):
            continue
        good.setdefault(i, []).append(np.floor(256 * np.asarray(np.asarray(x, np.float32), float)).astype(int))
    dims = max((len(v) for vs in good.values() for v in vs), default=0)
    pad = lambda v: np.concatenate([v, np.zeros(dims - len(v), int)])
    out = set()
    for q, vs in good.items():
        if q % every:
            continue
        score = {}
        for v in vs:
            for i, ws in good.items():
                if i != q:
                    s = max(int(pad(v) @ pad(w)) for w in ws)
                    score[i] = max(score.get(i, s), s)
        for r, (i, s) in enumerate(sorted(score.items(), key=lambda t: (-t[1], t[0]))[:k]):
            out.add((q, r + 1, i, s))
    return out


def run(spark, rows, **options):
    return {tuple(r) for r in knn.top_k(spark.createDataFrame(rows, SCHEMA), **options).collect()}


@pytest.mark.parametrize("pivots,block", [(1, 16384), (6, 40)])
def test_equals_brute_force_with_ties_and_copies(spark, monkeypatch, pivots, block):
    monkeypatch.setattr(knn, "BLOCK", block)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 8))
    rows = [(i, (centres[i % 4] + rng.normal(size=8) * 0.1).round(2).tolist(), 0, 0) for i in range(400)]
    same = rows[3][1]
    rows += [(i, same, 1, 0) for i in range(1000, 1150)]       # a large group of copies
    assert run(spark, rows, pivots=pivots) == brute(rows)


def test_nulls_short_vectors_repeats_and_few_rows(spark):
    rows = [(0, [0.5, 0.25], 0, 0), (0, [0.5, 0.25], 0, 0), (50, [0.1, None], 0, 0), (100, None, 0, 0),
            (None, [1.0, 1.0], 0, 0), (7, [float("nan"), 1.0], 0, 0), (8, [float("inf")], 0, 0), (9, [-0.5], 0, 0),
            (10, [0.5, 0.25, 3.0], 0, 0), (150, [], 0, 0)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert {r[0] for r in got} == {0, 150}


def test_empty_table_and_no_query(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert knn.top_k(df).collect() == []
    assert run(spark, [(1, [1.0], 0, 0), (2, [2.0], 0, 0)]) == set()


def test_large_components_stay_exact(spark):
    rows = [(0, [3e6, 1.0], 0, 0), (1, [3e6, 2.0], 0, 0), (2, [3e6, 2.0], 0, 0), (3, [-3e6, 9.0], 0, 0)]
    assert run(spark, rows) == brute(rows)
