"""Filter audit against a plain count of every order, and its rationals against the definition."""

import re
from fractions import Fraction
from itertools import permutations
from math import factorial

import pytest

from rankforge.llm import filter_audit as A

DOCS = "doc_id long, text string, lang string, part string, mask int"
LABELS = "doc_id long, quality int, toxic int, n int"
PLAIN = " ".join(f"word{i}" for i in range(120))


def plain_fails(rows):
    """Row number -> set of filters that it fails."""
    least, out = {}, []
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, *_ in rows:
        t = t or ""
        w, bad = re.findall("[^\x20\x09-\x0d]+", t), set()
        bad |= {"A"} if len(w) < 100 else set()
        bad |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
        bad |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        bad |= {"D"} if re.search("[#$%&*|]", t) else set()
        bad |= {"E"} if i is not None and i > least[t] else set()
        out.append(bad)
    return out


def plain_audit(rows, labels):
    fails, out = plain_fails(rows), {}
    labels = [x for x in labels if x[0] is not None]
    marks = [(any(a == i and q == 1 for a, q, _ in labels), any(a == i and x == 1 for a, _, x in labels)) for i, *_ in rows]
    for part in {r[2] or "" for r in rows}:
        own = [(f, m) for f, m, r in zip(fails, marks, rows) if (r[2] or "") == part]
        totals = {f: 0 for f in A.FILTERS}
        found = {}
        for order in map("".join, permutations(A.FILTERS)):
            for step, x in enumerate(order, 1):
                before = set(order[:step - 1])
                gone = [m for f, m in own if x in f and not f & before]
                totals[x] += len(gone)
                found[order, step] = (sum(not f & (before | {x}) for f, _ in own), len(gone), sum(x in f and bool(f & before) for f, _ in own),
                                      sum(f == {x} for f, _ in own), sum(g for g, _ in gone), sum(t for _, t in gone), x)
        out |= {(part, *k): (*v[:6], totals[v[6]]) for k, v in found.items()}
    return out


def check(spark, rows, labels):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], DOCS).repartition(3)
    marks = spark.createDataFrame([(*x, 9) for x in labels], LABELS)
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in A.audit(df, marks).collect()}
    assert got == plain_audit(rows, labels)
    return got


def test_audit_equals_a_count_of_every_order(spark):
    long = {"": PLAIN, "B": "same " * 130, "C": PLAIN + " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 10, "D": PLAIN + " 5 %", "A": "short text"}
    texts = [long[a] + (" #" if d else "") for a in long for d in (0, 1)]
    rows = [(i, texts[(i * i + i // 7) % len(texts)], ("en", "de", None, "")[i % 4]) for i in range(140)]
    labels = [(i, (i // 2) % 2, i % 3 == 0) for i in range(0, 150, 2)]
    got = check(spark, rows, [(i, int(q), int(x)) for i, q, x in labels])
    assert {k[0] for k in got} == {"", "en", "de"} and len(got) == 3 * 600


def test_nulls_repeats_ties_very_long_and_unknown_labels(spark):
    rows = [(1, None, "en"), (2, "", "en"), (None, "", "en"), (3, PLAIN, "en"), (3, PLAIN, "en"), (3, PLAIN, "fr"), (4, PLAIN, "fr"),
            (5, "x " * 50_000, "en"), (6, "Ünïcode Ähm", "en"), (7, " " + PLAIN, "en"), (-8, PLAIN + " ", "en")]
    labels = [(3, 1, 0), (3, 0, 1), (4, None, 1), (99, 1, 1), (None, 1, 1), (2, 1, None)]
    check(spark, rows, labels)


def test_a_hot_text_over_many_ids(spark):
    rows = [(i, PLAIN if i % 3 else f"{PLAIN} {i}", "en") for i in range(600)]
    got = check(spark, rows, [])
    assert got["en", "EABCD", 1][1] == 399


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert A.audit(docs, labels).count() == 0
    assert A.audit(spark.createDataFrame([(1, "a", None, "", 0)], DOCS), labels).count() == 600


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_least_squares_give_the_shapley_weights(n):
    weights = A.attribution(n)
    for f in range(n):
        for s in range(1 << n):
            size = bin(s).count("1")
            if s >> f & 1:
                want = Fraction(factorial(size - 1) * factorial(n - size), factorial(n))
            else:
                want = -Fraction(factorial(size) * factorial(n - size - 1), factorial(n))
            assert weights[f][s] == want or s == 0


def test_singular_equations_are_refused():
    with pytest.raises(ValueError):
        A.solve([[Fraction(1), Fraction(1)], [Fraction(1), Fraction(1)]], [[Fraction(1)], [Fraction(2)]])
