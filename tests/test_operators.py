"""Distributed operators against their one-task window / brute-force equivalents."""

import random

import pytest
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from rankforge.operators import ordinal
from rankforge.operators.latest import latest_per_key
from rankforge.operators.nested import merge_pages, merged_positions, slice_records
from rankforge.operators.quality import expect_or_drop, expectation_report


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, NULL keys, duplicate versions."""
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else (None if i % 17 == 0 else f"k{rnd.randrange(40)}")
        rows.append((i, key, rnd.randrange(5), rnd.random()))
    return spark.createDataFrame(rows, "id bigint, key string, ver int, v double")


def test_latest_per_key_matches_row_number(skewed):
    got = latest_per_key(skewed, ["key"], "ver", ["v"])
    w = Window.partitionBy("key").orderBy(F.col("ver").desc(), F.col("v").desc(), F.col("id").desc())
    want = skewed.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert got.columns == skewed.columns
    assert sorted(got.collect()) == sorted(want.collect())


def test_with_ordinal_matches_row_number(skewed):
    got = ordinal.with_ordinal(skewed, ["key"], ["v", "id"], "pos", num_partitions=7)
    w = Window.partitionBy("key").orderBy("v", "id")
    want = skewed.withColumn("pos", F.row_number().over(w) - 1)
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_global_ordinal_descending(skewed):
    got = ordinal.with_ordinal(skewed, [], [F.col("v").desc(), "id"], "pos", num_partitions=5)
    want = skewed.withColumn("pos", F.row_number().over(Window.orderBy(F.col("v").desc(), "id")) - 1)
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_running_total_matches_window(skewed):
    got = ordinal.running_total(skewed, ["key"], ["id"], "ver", "before", num_partitions=6)
    w = Window.partitionBy("key").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    want = skewed.withColumn("before", F.coalesce(F.sum("ver").over(w), F.lit(0)))
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_page_slice_matches_window(skewed):
    got = ordinal.page_slice(skewed, [F.col("v").desc(), "id"], offset=2, limit=3, per_page=50)
    ranked = skewed.withColumn("rn", F.row_number().over(Window.orderBy(F.col("v").desc(), "id")) - 1)
    want = (ranked.where("rn >= 100 AND rn < 250")
            .withColumn("page", (F.floor(F.col("rn") / 50) + 1).cast("bigint")).drop("rn"))
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("sample,most", [(64, 100), (256, 10 ** 6), (10 ** 6, 10)])
def test_page_slice_selects_for_any_sample(spark, monkeypatch, sample, most):
    """Small samples (bounds widened, counted again), samples of the whole table, slices numbered
    over many partitions; ties, nulls on either side, times, text; pages beyond the end."""
    monkeypatch.setattr(ordinal, "SAMPLE", sample)
    monkeypatch.setattr(ordinal, "SORTED", most)
    v = F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") * 37) % 101)
    df = spark.range(3000).select("id", v.alias("v"), F.timestamp_seconds(F.col("id") % 50).cast("timestamp_ntz").alias("t"),
                                  F.concat(F.lit("n'"), F.col("id") % 7).alias("s")).cache()
    for order in (["v DESC NULLS LAST", "id"], [F.col("v").asc_nulls_last(), F.col("id").desc()], ["t", "s desc", "`id`"])[:2 if sample > 64 else 3]:
        terms = [getattr(F.col(n), f"{'desc' if d else 'asc'}_nulls_{'first' if f else 'last'}")() for n, d, f in ordinal._directions(order)]
        ranked = df.withColumn("rn", F.row_number().over(Window.orderBy(*terms)) - 1)
        for offset, limit in ((0, 1), (40, 2), (58, 9)):
            got = ordinal.page_slice(df, order, offset, limit, 50)
            want = ranked.where((F.col("rn") >= offset * 50) & (F.col("rn") < (offset + limit) * 50))
            want = want.withColumn("page", (F.floor(F.col("rn") / 50) + 1).cast("bigint")).drop("rn")
            assert got.count() == want.count() and got.exceptAll(want).count() == 0, (order, offset, limit)


def test_page_slice_of_one_hot_value_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(ordinal, "SAMPLE", 50)
    monkeypatch.setattr(ordinal, "SORTED", 100)
    same = spark.range(2000).select(F.lit(1).alias("v"), "id")
    assert ordinal.page_slice(same, ["v"], 3, 2, 100).count() == 200
    assert ordinal.page_slice(same.limit(0), ["v"], 0, 2, 100).count() == 0
    assert ordinal.page_slice(same, ["v"], 3, 0, 100).count() == 0


def test_page_slice_rejects_bad_arguments(skewed):
    with pytest.raises(ValueError):
        ordinal.page_slice(skewed, ["id"], -1, 1, 10)


def test_merged_positions_equal_merge_then_posexplode(spark):
    rows = [(1, p, list(range(p * 10, p * 10 + (p % 4) + 1)), f"env{p}") for p in range(30)]
    rows += [(2, 5, [], "e"), (2, 3, [7, 8], "f"), (None, 1, [1], "n")]
    df = spark.createDataFrame(rows, "k int, page int, arr array<int>, env string")
    merged = merge_pages(df, ["k"], "page", "arr", ["env"])
    envs = {r.k: r.env for r in merged.collect()}
    assert envs[1] == "env0" and envs[2] == "f"
    want = merged.select("k", F.posexplode("arr").alias("pos", "value"))
    got = merged_positions(df, ["k"], "page", "arr")
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_merged_positions_with_repeated_and_null_pages(spark):
    df = spark.createDataFrame([(1, 1, ["a", "b"]), (1, 1, ["c"]), (1, 2, ["d"]), (1, None, ["e"]), (2, 7, None)],
                               "k int, page int, arr array<string>")
    want = merge_pages(df, ["k"], "page", "arr").select("k", F.posexplode("arr").alias("pos", "value"))
    got = merged_positions(df, ["k"], "page", "arr")
    assert sorted(got.collect()) == sorted(want.collect())
    assert sorted(r.value for r in got.collect()) == list("abcde")


def test_slice_records_keeps_envelope(spark):
    df = spark.createDataFrame([({"total": 5, "data": [1, 2, 3, 4, 5]},)],
                               "g struct<total:int, data:array<int>>")
    row = slice_records(df, "g.data", 3).first()
    assert row.g.total == 5 and row.g.data == [1, 2, 3]


RULES = {"has_a": "a IS NOT NULL", "pos_b": "b > 0"}


def test_expect_or_drop_and_report(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (1, None), (1, -1), (None, -1)], "a int, b int")
    obs = Observation("q")
    kept = expect_or_drop(df, RULES, obs)
    assert kept.collect() == [(1, 1)]                     # NULL predicate drops the row
    m = obs.get
    assert (m["rows_tested"], m["failed_has_a"], m["failed_pos_b"]) == (5, 2, 3)
    rep = {r.rule: (r.rows_tested, r.rows_failed, r.rows_passed) for r in expectation_report(df, RULES).collect()}
    assert rep == {"has_a": (5, 2, 3), "pos_b": (5, 3, 2), "ALL": (5, 4, 1)}


def test_merged_positions_order_only_pages_by_size(spark):
    """No array is sorted or written: where no page repeats, the plan reads a table of numbers."""
    df = spark.range(400).select((F.col("id") % 3).alias("k"), F.col("id").alias("page"),
                                 F.array_repeat(F.col("id"), 5).alias("arr"))
    got = merged_positions(df, ["k"], "page", "arr")
    tree = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in tree and "Union" not in tree
    assert [line for line in tree.splitlines() if "Scan ExistingRDD" in line and "arr" in line] == []
    assert got.count() == 2000 and got.where("value % 3 != k").isEmpty()
