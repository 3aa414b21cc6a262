"""Hierarchical weighted hash tree."""

import math
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from rankforge.llm import sharding as S

SCHEMA = "doc_id long, text string, shard int, h string"


def plain_place(key, leaves):
    node = ""
    for level in S._children(leaves):
        draw = lambda n, w: math.log(((xxhash.xxh64_intdigest(f"{key}|{n}".encode(), 42) >> 11) + 0.5) / 2 ** 53) / w
        node = max((draw(n, w), n) for n, w in level[node])[1]
    return int(node)


def test_placement_equals_plain_python_and_grows_into_the_new_shard(spark):
    rows = [(i, f"text {i % 7}" * (i % 5), 0, "") for i in range(3000)]
    found = S.shard(spark.createDataFrame(rows, SCHEMA), S.layout(24), S.layout(24, 1)).collect()
    texts = {i: t for i, t, *_ in rows}
    assert len(found) == 3000
    for r in found:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 24)
    for r in found[:200]:
        assert r.shard == plain_place(r.doc_id, S.layout(24)) and r.grown_shard == plain_place(r.doc_id, S.layout(24, 1))
    by = {}
    for r in found:
        by.setdefault(r.shard, []).append(r.slot)
    assert set(by) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert 3000 / 25 * 0.7 < sum(r.grown_shard == 24 for r in found) < 3000 / 25 * 1.3


@pytest.mark.parametrize("n", [1, 5, 23, 24])
def test_one_more_shard_takes_rows_only_into_itself(spark, n):
    ids = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    small, large = S.layout(n, 1), S.layout(n, 2)
    assert ids.where(S.place(F.col("k"), S.layout(n)) != S.place(F.col("k"), small)).where(
        S.place(F.col("k"), small) != n).count() == 0
    moved = ids.select(S.place(F.col("k"), small).alias("a"), S.place(F.col("k"), large).alias("b")).where("a <> b")
    assert {r.b for r in moved.select("b").distinct().collect()} == {n + 1}


def test_a_growing_weight_confines_movement_to_its_subtree(spark):
    old = S.layout(24)
    new = [S.Leaf(x.shard, x.region, x.rack, 3.0 if x.shard == 5 else 1.0) for x in old]
    region = {x.shard: x.region for x in old}
    ids = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    got = ids.select(S.place(F.col("k"), old).alias("a"), S.place(F.col("k"), new).alias("b")).collect()
    grown = region[5]
    assert all(r.a == r.b or region[r.b] == grown for r in got)
    share = sum(r.b == 5 for r in got) / 4000
    assert 3 / 26 * 0.7 < share < 3 / 26 * 1.3


def test_nulls_repeats_runs_and_empty(spark, monkeypatch):
    monkeypatch.setattr(S, "RUN", 4)
    rows = [(None, None, 0, ""), (None, None, 0, ""), (1, None, 0, ""), (1, "", 0, "")] + [(2, "same", 0, "")] * 23
    found = S.shard(spark.createDataFrame(rows, SCHEMA), S.layout(3)).collect()
    assert len(found) == 27 and all(r.grown_shard is None for r in found)
    assert sum(r.doc_id is None and r.size == 8 and r.text_crc32 == 0 for r in found) == 2
    by = {}
    for r in found:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert S.shard(spark.createDataFrame([], SCHEMA), S.layout(24)).count() == 0
    with pytest.raises(ValueError):
        S.layout(0)
