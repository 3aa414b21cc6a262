"""Mixing by subset sums: targets against plain water filling, sums against all subsets."""

import re
from fractions import Fraction
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rankforge.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size string, rank int"


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while total:
        rest = [s for s in names if s not in full]
        level = Fraction(total - sum(most * sizes[s] for s in full), sum(weight[s] for s in rest)) if rest else Fraction(0)
        more = {s for s in rest if level * weight[s] > most * sizes[s]}
        if not more:
            return {s: Fraction(most * sizes[s]) if s in full else level * weight[s] for s in names}
        full |= more
    return {s: Fraction(0) for s in names}


def check(spark, rows, near=1):
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], SCHEMA)
    got = M.mix(df.repartition(4)).collect()
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    assert sorted((str(r.doc_id), str(r.source), r["size"]) for r in got) == sorted((str(i), str(s), size(t)) for i, t, s in rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want, taken = plain_targets(sizes), {s: 0 for s in sizes}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]), rel=1e-12)
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= near, (s, taken[s], float(want[s]))
    again = M.mix(df.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r["size"], str(r.source), r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))
    return got


def test_targets_and_taken_words_over_sources_and_nulls(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))), ["web", "Web", "böks", "books", None, "tiny"][int(rng.choice(6, p=[.4, .2, .1, .1, .1, .1]))])
            for i in range(900)] + [(1000, "one", "a"), (1001, None, "empty"), (1002, "", "empty"), (None, "x y z", "web")]
    rows += [(5000, "long " * 4_000, "web")]
    got = check(spark, rows)
    assert {r.copies for r in got if r.source == "a"} == {3}      # a small source: all it may


def test_hot_length_repeated_rows_and_runs(spark, monkeypatch):
    monkeypatch.setattr(M, "RUN", 8)
    rows = [(i, "same length here", "hot") for i in range(400)] + [(7, "the same row again", "hot")] * 60
    rows += [(i, "w " * (i % 13 + 1), f"s{i % 4}") for i in range(400)]
    check(spark, rows, near=4)


def test_empty_tables_and_texts(spark):
    assert M.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    got = M.mix(spark.createDataFrame([(1, None, None, "", 0), (2, " ", "s", "", 0)], SCHEMA)).collect()
    assert sorted((r.doc_id, r["size"], r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    with pytest.raises(ValueError):
        M.mix(spark.createDataFrame([], SCHEMA), weights=())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(0, 3)), min_size=1, max_size=5, unique_by=lambda x: x[0]), st.integers(0, 120))
def test_nearest_sum_equals_all_subsets(items, budget):
    lengths, spare = (np.array(x, np.int64) for x in zip(*items))
    got = M.nearest_sum(lengths, spare, budget)
    assert (got >= 0).all() and (got <= spare).all()
    sums = {int((np.array(c) * lengths).sum()) for c in product(*[range(n + 1) for n in spare])}
    assert abs(int((got * lengths).sum()) - budget) == min(abs(s - budget) for s in sums)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 200), min_size=40, max_size=200), st.floats(0, 1), st.floats(0, 0.999))
def test_fit_budget_is_exact_where_lengths_are_many(sizes, share, offset):
    lengths, counts = np.unique(np.array([*sizes, *range(1, 60)], np.int64), return_counts=True)
    budget = int(share * int((lengths * counts).sum()))
    got = M.fit_budget(lengths, counts, budget, offset)
    assert (got >= 0).all() and (got <= counts).all() and int((got * lengths).sum()) == budget


def test_fit_budget_beyond_the_span_and_of_few_documents():
    rng = np.random.default_rng(1)
    lengths, counts = np.unique(rng.integers(1, 50_000, size=20_000), return_counts=True)
    budget = int((lengths * counts).sum()) * 2 // 5
    assert int((M.fit_budget(lengths, counts, budget, 0.3) * lengths).sum()) == budget
    small = np.array([7, 40_000]), np.array([100, 1])
    assert int((M.fit_budget(*small, 25_412, 0.5) * small[0]).sum()) == 40_000        # nothing is nearer
    assert M.fit_budget(np.array([7, 1000]), np.array([100, 1]), 1200, 0.5, most=3).tolist() in ([171, 0], [29, 1])
    got = M.fit_budget(np.array([5, 10 ** 7]), np.array([1, 1]), 9_000_000, 0.0)
    assert set(got.tolist()) <= {0, 1}
    assert M.fit_budget(np.array([3]), np.array([4]), 12, 0.9).tolist() == [4]
