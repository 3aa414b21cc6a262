"""Property tests (hypothesis): newest-per-key equals the window form for any data, and the
result does not depend on the order loads arrive in."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from rankforge.operators.latest import latest_per_key

ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3) | st.none(),
              st.integers(0, 4), st.sampled_from(["x", "y", None])),
    min_size=0, max_size=40)

SCHEMA = "k string, c int, ver int, payload string"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_latest_equals_row_number(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = latest_per_key(df, ["k", "c"], "ver", ["payload"])
    w = Window.partitionBy("k", "c").orderBy(F.col("ver").desc(), F.col("payload").desc_nulls_last())
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, seed=st.integers(0, 1000))
def test_load_order_does_not_matter(spark, rows, seed):
    loads = [rows[i::3] for i in range(3)]
    order = list(range(3))
    random.Random(seed).shuffle(order)
    dfs = [spark.createDataFrame(loads[i], SCHEMA) for i in order]
    a = latest_per_key(dfs[0].unionByName(dfs[1]).unionByName(dfs[2]), ["k", "c"], "ver", ["payload"])
    # incremental: newest of (newest of the first two loads) and the third
    step = latest_per_key(dfs[0].unionByName(dfs[1]), ["k", "c"], "ver", ["payload"])
    b = latest_per_key(step.unionByName(dfs[2]), ["k", "c"], "ver", ["payload"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


XY = st.lists(
    st.tuples(st.sampled_from(["g", "h", None]),
              st.floats(-1e4, 1e4, allow_nan=False) | st.none(),
              st.floats(-1e4, 1e4, allow_nan=False) | st.none()),
    min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=XY, m=st.floats(-5, 5, allow_nan=False), b=st.floats(-100, 100, allow_nan=False))
def test_r_squared_equals_direct_sums(spark, rows, m, b):
    """Sums of squares equal the row-by-row sums for any data and line, to their own size."""
    from rankforge.operators import analytics as an

    df = spark.createDataFrame(rows, "g string, x double, y double")
    groups = sorted({r[0] for r in rows}, key=lambda v: (v is None, v))
    fit = spark.createDataFrame([(g, m, b) for g in groups], "g string, m double, b double")
    got = {r.g: r for r in an.r_squared(df, fit, "x", "y", ["g"]).collect()}
    assert set(got) == set(groups)
    for g in groups:
        ys = [y for k, _, y in rows if k == g and y is not None]
        pairs = [(x, y) for k, x, y in rows if k == g and x is not None and y is not None]
        base = sum((y - sum(ys) / len(ys)) ** 2 for y in ys) if ys else None
        reg = sum((y - (m * x + b)) ** 2 for x, y in pairs) if pairs else None
        for have, want in ((got[g].sse_base, base), (got[g].sse_reg, reg)):
            if want is None:
                assert have is None
            else:
                assert abs(have - want) <= 1e-9 * (1.0 + want)


UPSERT_ROWS = st.lists(
    st.tuples(st.integers(0, 30) | st.none(), st.integers(0, 5), st.sampled_from(["p", "q", "r", None])),
    min_size=1, max_size=60)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=UPSERT_ROWS, cuts=st.integers(1, 3), seed=st.integers(0, 99), buckets=st.integers(1, 4))
def test_merged_batches_equal_newest_of_all(spark, rows, cuts, seed, buckets):
    """Any cut of the input into batches and any arrival order give the newest row per key over
    everything (NULL keys included), even without state."""
    import uuid

    from rankforge.session import shared_path
    from rankforge.streaming.upsert import KeyedTable, publish, stage_batch

    schema = "k int, ver int, payload string"
    parts = [rows[i::cuts] for i in range(cuts)]
    random.Random(seed).shuffle(parts)
    root = shared_path(spark, "prop", "merge")
    empty = spark.createDataFrame([], schema)
    t = KeyedTable(f"prop_{uuid.uuid4().hex[:8]}", ["k"], "ver", ["payload"], num_buckets=buckets, path=f"{root}/t")
    t.create(spark, empty.schema)
    for batch_id, part in enumerate(p for p in parts if p):
        publish(stage_batch(spark, spark.createDataFrame(part, schema), t, f"{root}/staged/{batch_id}"), t)
    want = latest_per_key(spark.createDataFrame(rows, schema), ["k"], "ver", ["payload"])
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(t.read(spark).select("k", "ver", "payload").collect(), key=key) == sorted(want.collect(), key=key)


PAGES = st.dictionaries(
    st.tuples(st.sampled_from([1, 2, None]), st.integers(0, 12)),
    st.lists(st.integers(0, 99), max_size=5) | st.none(),
    min_size=1, max_size=25)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pages=PAGES)
def test_merged_positions_equal_python_concatenation(spark, pages):
    """Distributed page merge = concatenating each key's pages in page order (NULL and empty
    pages contribute nothing) and numbering the records from 0."""
    from rankforge.operators.nested import merged_positions

    rows = [(k, p, arr) for (k, p), arr in pages.items()]
    df = spark.createDataFrame(rows, "k int, page int, arr array<int>")
    got = merged_positions(df, ["k"], "page", "arr")
    want = []
    for k in {k for k, _ in pages}:
        mine = sorted(((page, arr) for (kk, page), arr in pages.items() if kk == k), key=lambda x: x[0])
        merged = [v for _, arr in mine for v in (arr or [])]
        want += [(k, i, v) for i, v in enumerate(merged)]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


QUALITY_ROWS = st.lists(
    st.tuples(st.integers(-2, 2) | st.none(), st.sampled_from(["a", "", None]),
              st.floats(-1, 1) | st.just(float("nan")) | st.none()),
    min_size=0, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=QUALITY_ROWS)
def test_report_all_row_counts_the_dropped_rows(spark, rows):
    """The ALL row of the report is exactly what expect_or_drop removes; per-rule failures
    count NULL results as failures, like the drop."""
    from rankforge.operators.quality import expect_or_drop, expectation_report

    rules = {"pos": "n > 0", "named": "s <> ''", "small": "x < 0.5"}
    df = spark.createDataFrame(rows, "n int, s string, x double")
    report = {r.rule: r for r in expectation_report(df, rules).collect()}
    kept = expect_or_drop(df, rules).count()
    assert report["ALL"].rows_tested == len(rows)
    assert report["ALL"].rows_failed == len(rows) - kept
    assert report["pos"].rows_failed == sum(1 for n, _, _ in rows if n is None or n <= 0)
    assert report["named"].rows_failed == sum(1 for _, s, _ in rows if s is None or s == "")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(0, 120), offset=st.integers(0, 6), limit=st.integers(0, 4),
       per_page=st.integers(1, 20))
def test_page_slice_equals_python_slice(spark, n, offset, limit, per_page):
    """The distributed slice gives Python's sort-and-slice, with pages."""
    from rankforge.operators import ordinal

    vals = [(i, (i * 37) % 11) for i in range(n)]
    df = spark.createDataFrame(vals, "id int, v int")
    got = ordinal.page_slice(df, [F.col("v").desc(), "id"], offset, limit, per_page).collect()
    order = sorted(vals, key=lambda r: (-r[1], r[0]))
    lo, hi = offset * per_page, (offset + limit) * per_page
    want = [(i, v, j // per_page + 1) for j, (i, v) in enumerate(order) if lo <= j < hi]
    assert sorted(tuple(r) for r in got) == sorted(want)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-10**7, 10**7), min_size=1, max_size=60))
def test_time_helpers_equal_python(spark, values):
    """Epoch ms -> whole seconds truncates toward zero; seconds -> MM:SS pads and cuts each
    part to two characters; ms -> seconds truncates toward zero."""
    import datetime as dt
    import math

    from rankforge.functions import epoch_to_timestamp, minutes_seconds, ms_to_seconds

    def lpad2(text):
        return text[:2] if len(text) >= 2 else "0" * (2 - len(text)) + text

    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = df.select("v", epoch_to_timestamp("v", "ms").cast("timestamp_ntz").alias("ts"),
                    ms_to_seconds("v").alias("sec"), minutes_seconds("v").alias("mmss")).collect()
    epoch = dt.datetime(1970, 1, 1)
    for r in got:
        v = r.v
        assert r.ts == epoch + dt.timedelta(seconds=int(v / 1000)), v
        assert r.sec == int(v / 1000), v
        assert r.mmss == f"{lpad2(str(math.floor(v / 60)))}:{lpad2(str(int(math.fmod(v, 60))))}", v


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="aBcD _-\t\n\r\x0b\f", max_size=12), min_size=1, max_size=40))
def test_text_helpers_equal_python(spark, texts):
    """Whitespace runs (ASCII whitespace, CR/LF included) become one space and the ends are
    trimmed; pascal style splits lower-upper pairs, then each space-separated word is
    capitalised and the rest lower-cased."""
    import re

    from rankforge.functions import to_title_case, trim_whitespace

    def initcap(s):
        return " ".join(w[:1].upper() + w[1:].lower() for w in s.split(" "))

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", trim_whitespace("t").alias("ws"), to_title_case("t", "Pascal ").alias("pc")).collect()
    for r in got:
        assert r.ws == re.sub(r"[ \t\n\x0b\f\r]+", " ", r.t).strip(" "), repr(r.t)
        assert r.pc == initcap(re.sub(r"([a-z])([A-Z])", r"\1 \2", r.t)), repr(r.t)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(-50, 50) | st.none(), st.text(alphabet="ab|é\\\\N", max_size=4) | st.none()),
                     min_size=1, max_size=30))
def test_surrogate_key_equals_hashlib(spark, rows):
    """SHA-256 of the parts with their lengths; different tuples get different keys."""
    import hashlib

    from rankforge.functions import surrogate_key

    df = spark.createDataFrame(rows, "a int, b string")
    got = df.select("a", "b", surrogate_key("a", "b").alias("k")).collect()
    for r in got:
        text = "".join("-" if v is None else f"{len(str(v))}:{v}" for v in (r.a, r.b))
        assert r.k == hashlib.sha256(text.encode("utf-8")).hexdigest()
    assert len({(r.a, r.b) for r in got}) == len({r.k for r in got})

