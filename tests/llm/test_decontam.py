"""Containment search against brute force."""

import random

from plain import shingles_of  # noqa: F401
from rankforge.llm import decontam as D

DOCS = "doc_id long, text string, item_id int, key string"


def brute(docs, items, shingles_of, width=5, percent=80):
    out = {}
    for i, it, *_ in items:
        want = shingles_of(it, width)
        for d, t, *_ in docs:
            common = len(want & shingles_of(t, width))
            if want and 100 * common >= percent * len(want):
                key = (d, i, hash(t))
                out[key] = max(out.get(key, (0, 0, 0)), (common / len(want), len(want), common))
    return sorted(((d, i, n, c, x) for (d, i, _), (x, n, c) in out.items()), key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(*x, 0, "k") for x in docs], DOCS)
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    found = D.leaks(d, b, **options).select("doc_id", "item_id", "item_shingles", "common", "containment").collect()
    return sorted((tuple(r) for r in found), key=str)


def test_equals_brute_force_around_the_threshold(spark, shingles_of):
    rng = random.Random(4)
    word = lambda: f"w{rng.randint(0, 5000)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([6, 9, 14, 30, 60])))) for k in range(40)]
    items += [(100, items[0][1]), (101, items[0][1] + " " + word())]
    docs = []
    for d in range(160):
        body = [word() for _ in range(rng.randint(0, 800))]
        passage = items[d % 40][1].split()
        for _ in range(d // 40):                       # 0 to 3 words changed
            passage[rng.randrange(len(passage))] = word()
        at = rng.randint(0, len(body))
        docs.append((d, " ".join(body[:at] + passage + body[at:]).upper()))
    docs += [(500 + k, " ".join(word() for _ in range(300))) for k in range(40)]
    got = run(spark, docs, items)
    assert got == brute(docs, items, shingles_of) and 40 < len(got) < 200


def test_edges(spark, shingles_of):
    items = [(1, "a b c d e f"), (2, None), (3, ""), (4, "one two"), (None, "p q r s t u"), (1, "a b c d e f")]
    docs = [(1, "x a b c d e f y"), (None, "a b c d e f"), (2, None), (3, ""), (4, "one two"), (5, "zero one two"),
            (6, "a b c d e f"), (6, "nothing here at all to see"), (7, "p q r s t u " * 9000), (8, "a b c d e f"), (8, "a b c d e f")]
    assert run(spark, docs, items) == brute(docs, items, shingles_of)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []
    assert run(spark, docs, [(2, None)]) == []


def test_clean_keeps_other_rows_whole(spark):
    docs = [(1, "x a b c d e f y", 0, "k"), (None, "a b c d e f", 1, "k"), (None, "fine", 2, "k"), (6, "a b c d e f", 3, "k"),
            (6, "other", 4, "k"), (7, None, 5, "k"), (6, "other", 4, "k")]
    items = spark.createDataFrame([(9, "a b c d e f")], "item_id long, text string")
    kept = D.clean(spark.createDataFrame(docs, DOCS), items)
    assert kept.columns == ["doc_id", "text", "item_id", "key"]
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted([docs[2], docs[4], docs[5], docs[6]], key=str)


def test_clean_with_clashing_names_nulls_and_empty_tables(spark):
    item = "alpha beta gamma delta epsilon zeta"
    rows = [(1, item, "k", 5, "x"), (None, item, "k", 5, "x"), (1, "nothing of it", "k", 6, "y"), (2, None, None, None, None),
            (2, "", "k", 1, "z"), (3, f"so {item} so", "k", 2, "w"), (3, f"so {item} so", "k", 2, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string, _doc long, key string")
    items = spark.createDataFrame([(7, item), (8, None)], "item_id long, text string")
    got = D.clean(docs, items)
    assert got.columns == docs.columns
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([rows[2], rows[3], rows[4]], key=str)
    assert D.clean(docs.limit(0), items).count() == 0 and D.clean(docs, items.limit(0)).count() == len(rows)
