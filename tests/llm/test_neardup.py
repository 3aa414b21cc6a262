"""Near-duplicate groups against brute force."""

import random

import numpy as np
import pytest

from plain import shingles_of  # noqa: F401
from rankforge.llm import components, neardup as N

SCHEMA = "doc_id long, text string, class_id int, band string"


def brute(rows, shingles_of, width, percent=80):
    """component and set size of every row; rows are told apart by their place."""
    sets = [shingles_of(t, width) for _, t, *_ in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    out = []
    for k, (i, *_) in enumerate(rows):
        least = None if i is None else min(rows[j][0] for j in range(len(rows)) if rows[j][0] is not None and find(j) == find(k))
        out.append((i, len(sets[k]), least, i is None or i == least))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 0, "") for i, t, *_ in rows], SCHEMA)
    return sorted((tuple(r) for r in N.groups(df, **options).collect()), key=str)


def family(rng, base, n, rates):
    vocabulary = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(n):
        words = list(base)
        for k in range(len(words)):
            if rng.random() < rng.choice(rates):
                words[k] = rng.choice(vocabulary)
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("width", [2, 5])
def test_equals_brute_force_with_chains_and_copies(spark, monkeypatch, shingles_of, width):
    monkeypatch.setattr(N, "BLOCK", 16)                  # the family spans several blocks
    rng = random.Random(11)
    base = [f"w{rng.randint(0, 300)}" for _ in range(120)]
    texts = [" ".join(base)] * 30 + family(rng, base, 70, [0.0, 0.01, 0.03, 0.06]) + [
        " ".join(f"w{rng.randint(0, 300)}" for _ in range(rng.randint(1, 60))) for _ in range(60)]
    rng.shuffle(texts)
    rows = [(1000 - k, t) for k, t in enumerate(texts)]
    assert run(spark, rows, width=width) == brute(rows, shingles_of, width)


def test_edges(spark, shingles_of):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one "), (6, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"),
            (7, "quite other words here"), (7, "a b c d e f"), (8, "x " * 30000), (9, "x " * 29999)]
    assert run(spark, rows, width=2) == brute(rows, shingles_of, 2)
    assert run(spark, []) == []
    assert run(spark, [(1, None), (None, None)]) == [(1, 0, 1, True), (None, 0, None, True)]


def test_one_per_group_keeps_clean_rows_and_columns(spark):
    rows = [(2, "a b c d e f g", 5, "x"), (1, "a b c d e f g", 6, "y"), (3, None, 7, "z"), (None, "a b c d e f g", 8, "n")]
    kept = N.one_per_group(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "class_id", "band"]
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted([rows[1], rows[2], rows[3]], key=str)


def test_one_per_group_where_ids_repeat(spark):
    base = [f"w{k}" for k in range(60)]
    text, near, other = " ".join(base), " ".join(["new", *base[1:]]), "quite other words stand in this one"
    copies = [(7, text, 0, "x")] * 40                       # one id, equal rows
    rows = [*copies, (7, other, 1, "x"), (9, other, 2, "x"),  # two groups of one smallest id
            (5, "one more text of its own here", 3, "x"), (8, near, 4, "x"), (8, "and a text that only it has", 5, "x"),
            (6, "a b c d e f g", 6, "p"), (6, "a b c d e f g", 7, "q"),  # one id, other columns differ
            (3, None, 8, "x"), (3, "", 9, "x"), (3, " ", 9, "x"), (None, text, 9, "x"), (None, text, 9, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = [tuple(r) for r in N.one_per_group(df).collect()]
    linked = sorted(r for r in kept if r[0] not in (None, 3))
    assert [r for r in linked if r[0] != 6] == sorted([copies[0], rows[40], rows[42], rows[44]])
    assert len([r for r in linked if r[0] == 6]) == 1
    assert len([r for r in kept if r[0] is None]) == 2 and len([r for r in kept if r[0] == 3]) == 3
    again = [tuple(r) for r in N.one_per_group(df.repartition(7)).collect()]
    assert sorted(again, key=str) == sorted(kept, key=str)


def test_sketch_fills_every_bin_and_estimates(shingles_of):
    rng = np.random.default_rng(1)
    values = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (1, 2, 5, 60, 5000)]
    bounds = np.cumsum([0] + [len(v) for v in values])
    got = N.sketch(np.concatenate(values), bounds, 128)
    assert (got != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert (N.sketch(np.concatenate(values), bounds, 128) == got).all()
    errors = []
    for _ in range(60):
        a = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        b = a.copy()
        b[:50] = rng.integers(0, 1 << 63, 50)
        s = N.sketch(np.concatenate([a, b]), np.array([0, 400, 800]), 512)
        errors.append((s[0] == s[1]).mean() - 350 / 450)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.025
    assert (N.sketch(np.zeros(0, np.uint64), np.array([0, 0]), 8) == np.uint64(0xFFFFFFFFFFFFFFFF)).all()


def test_components_of_a_long_path_and_a_hub(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(200, 200), (7, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    for per_task in (10 ** 6, 10):                      # one contraction, many that are joined
        got = dict(components.components(df, per_task).collect())
        assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 160)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_unequal_sets_of_one_digest_are_no_class(spark, shingles_of):
    """Digests of four bits collide all the time; the proofs keep the classes apart."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 5000, size=30))) for i in range(120)]
    rows += [(200 + i, rows[i][1]) for i in range(0, 60, 3)] + [(300, rows[7][1] + " tail"), (301, rows[7][1] + " other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.smallest for r in N.judged(df, 2, 80, N.BANDS, N.ROWS, bits=4).collect()}
    want = {r.doc_id: r.component_id for r in N.groups(df, width=2).collect()}
    assert got == want and len(set(want.values())) == 120


def test_one_per_group_with_clashing_names_and_maps(spark):
    schema = "doc_id long, text string, _key_id int, _KEY_ROW string, m map<string,int>, row long"
    rows = [(1, "one two three four five six", 6, "a", {"x": 1}, 3), (2, "one two three four five six", 8, "b", {"x": 2}, 4),
            (2, "one two three four five six", 8, "b", {"x": 3}, 4), (9, "something else in here for sure", 7, "c", None, None)]
    df = spark.createDataFrame(rows, schema)
    got = N.one_per_group(df)
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == [rows[0], rows[3]]
    assert N.one_per_group(df.limit(0)).count() == 0
