"""Fit, R^2, bootstrap and tail probability against NumPy / math on small inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankforge.operators import analytics as an

X = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 9.0]
Y = [2.1, 3.9, 6.2, 8.1, 9.8, 12.5, 13.9, 18.2]


@pytest.fixture(scope="module")
def xy(spark):
    rows = [("a", x, y) for x, y in zip(X, Y)] + [("flat", 3.0, 1.0), ("flat", 3.0, 2.0)]
    return spark.createDataFrame(rows, "g string, x double, y double")


def numpy_fit(x, y):
    x, y = np.array(x), np.array(y)
    m = (np.mean(x * y) - np.mean(x) * np.mean(y)) / (np.mean(x ** 2) - np.mean(x) ** 2)
    return m, np.mean(y) - m * np.mean(x)


def test_least_squares_matches_mean_formula(xy):
    fits = {r.g: r for r in an.least_squares(xy, "x", "y", ["g"]).collect()}
    m, b = numpy_fit(X, Y)
    assert fits["a"].m == pytest.approx(m, rel=1e-12) and fits["a"].b == pytest.approx(b, rel=1e-12)
    assert fits["flat"].m is None                   # equal x: no slope
    rounded = an.least_squares(xy.where("g = 'a'"), "x", "y", round_decimal=2).first()
    assert rounded.m == round(m, 2) and rounded.n == len(X)


def test_r_squared_of_given_line(xy):
    a = xy.where("g = 'a'")
    fit = an.least_squares(a, "x", "y", round_decimal=2)
    r = an.r_squared(a, fit, "x", "y").first()
    x, y = np.array(X), np.array(Y)
    base = np.sum((y - y.mean()) ** 2)
    reg = np.sum((y - (r.m * x + r.b)) ** 2)
    assert r.sse_base == pytest.approx(base) and r.sse_reg == pytest.approx(reg)
    assert r.r2 == round(1 - reg / base, 2)
    rep = an.fit_report(a, "x", "y").first()
    assert rep.n == len(X) and rep.r2 == r.r2


def test_r_squared_against_brute_force(spark):
    """Grouped R^2 equals the row-by-row sums, with NULL x / y rows, a NULL
    group key and a hot group far from the origin (large mean, small spread)."""
    rng = np.random.default_rng(7)
    rows = [("hot", 1e6 + float(i), 3e5 + 0.5 * i + float(rng.normal(0, 2))) for i in range(3000)]
    rows += [(None, float(i), 2.0 * i + 1.0) for i in range(5)]
    rows += [("holes", 1.0, 2.0), ("holes", None, 5.0), ("holes", 3.0, None), ("holes", 4.0, 9.5),
             ("holes", 6.0, 12.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    fit = an.least_squares(df, "x", "y", ["g"], round_decimal=2)
    got = {r.g: r for r in an.r_squared(df, fit, "x", "y", ["g"]).collect()}
    lines = {r.g: (r.m, r.b) for r in fit.collect()}
    assert set(got) == {"hot", None, "holes"}
    for g, (m, b) in lines.items():
        ys = [y for k, _, y in rows if k == g and y is not None]
        pairs = [(x, y) for k, x, y in rows if k == g and x is not None and y is not None]
        base = sum((y - np.mean(ys)) ** 2 for y in ys)
        reg = sum((y - (m * x + b)) ** 2 for x, y in pairs)
        assert got[g].sse_base == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert got[g].sse_reg == pytest.approx(reg, rel=1e-9, abs=1e-9)
        assert got[g].r2 == round(1 - reg / base, 2) + 0.0


def test_fit_points_and_line_recovery(xy):
    a = xy.where("g = 'a'")
    fit = an.least_squares(a, "x", "y")
    pts = an.fit_points(fit, a, "x", points=100)
    rows = sorted(pts.collect(), key=lambda r: r.i)
    assert len(rows) == 100 and rows[0].x == min(X) and rows[-1].x == pytest.approx(max(X))
    line = an.line_from_points(pts).first()
    f = fit.first()
    assert line.m == pytest.approx(f.m) and line.b == pytest.approx(f.b)


def test_bootstrap_is_exact_size_with_replacement(spark):
    df = spark.range(37).withColumnRenamed("id", "k").withColumn("payload", F.col("k") * 2)
    s1 = an.bootstrap_sample(df, ["k"], n=500, seed=42).collect()
    s2 = an.bootstrap_sample(df.repartition(7), ["k"], n=500, seed=42).collect()
    assert len(s1) == 500 and sorted(s1) == sorted(s2)
    assert {r.draw for r in s1} == set(range(500))
    assert all(r.payload == 2 * r.k for r in s1)
    assert len({r.k for r in s1}) == 37                # 500 draws of 37 rows: every row, repeats
    assert an.bootstrap_sample(df, ["k"], n=0).count() == 0
    assert an.bootstrap_sample(df.limit(0), ["k"], n=5).count() == 0


def test_bootstrap_follows_the_positions(spark):
    import hashlib

    df = spark.range(1000).withColumnRenamed("id", "k")
    got = {r.draw: r.k for r in an.bootstrap_sample(df, ["k"], n=80, seed=7).collect()}
    h = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    ranked = sorted(range(1000), key=lambda k: (h(f"7|{k}"), k))
    assert all(got[i] == ranked[h(f"7:{i}") % 1000] for i in range(80))


@pytest.mark.parametrize("distinct", [1, 25, 5000])
def test_bootstrap_is_exact_whatever_the_keys(spark, distinct):
    """n rows for one key, for few and for unique ones; each row is about as likely as any other."""
    df = spark.range(5000).select((F.col("id") % distinct).alias("k"), F.col("id").alias("row"), (F.col("id") / 3).alias("x"))
    for tie in ([], ["x"]):
        got = an.bootstrap_sample(df, ["k"], n=3000, seed=5, tie=tie)
        rows = got.collect()
        assert got.columns == ["draw", "k", "row", "x"] and sorted(r.draw for r in rows) == list(range(3000))
        assert all(r.k == r.row % distinct for r in rows)
        seen = len({r.row for r in rows})
        assert abs(seen - 5000 * (1 - math.exp(-0.6))) < 150          # with replacement: 45 % of the rows
        again = an.bootstrap_sample(df.repartition(5), ["k"], n=3000, seed=5, tie=tie)
        assert sorted(again.collect()) == sorted(rows)


@pytest.mark.parametrize("distinct", [1, 25, 5000])
def test_bootstrap_is_the_same_however_blocks_are_numbered(spark, monkeypatch, distinct):
    df = spark.range(5000).select((F.col("id") % distinct).alias("k"), F.col("id").alias("row"))
    want = sorted(an.bootstrap_sample(df, ["k"], n=700, seed=3).collect())
    monkeypatch.setattr(an, "IN_BLOCK", 0)
    assert sorted(an.bootstrap_sample(df, ["k"], n=700, seed=3).collect()) == want


def test_bootstrap_of_equal_rows_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1)] * 40 + [("a", 2)] * 60, "k string, v int").withColumn("m", F.create_map(F.lit("x"), "v"))
    got = an.bootstrap_sample(df, ["k"], n=400, seed=1).collect()
    assert len(got) == 400 and 120 < sum(r.k is None for r in got) < 200 and all(r.m == {"x": r.v} for r in got)


def test_fit_report_reads_its_sample_once(spark):
    """The sample is a checkpoint: nothing of the table is read again by what uses it."""
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2.0).alias("x"), (F.col("id") * 6.0 + 1).alias("y"))
    rep = an.fit_report(an.bootstrap_sample(df, ["k"], n=50), "x", "y")
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in plan and "ExistingRDD" in plan
    assert (rep.first().m, rep.first().b, rep.first().n) == (3.0, 1.0, 50)


def test_draw_positions_reach_beyond_32_bits(spark):
    rows = 10 ** 13
    got = [r.p for r in spark.range(400).select(an.draw_position(1, F.col("id"), F.lit(rows)).alias("p")).collect()]
    assert max(got) > 9 * 10 ** 12 and min(got) < 10 ** 12 and sum(p > 2 ** 32 for p in got) > 390


def test_joint_probability(spark):
    rows = [("e", "c", 60.0, 10.0), ("e", "c", 60.0, 70.0), ("e", "c", 1.0, 1.0), ("e", "c", None, 99.0), ("x", "c", 99.0, 99.0)]
    df = spark.createDataFrame(rows, "encounter_name string, class string, rDPS double, aDPS double")
    r = an.joint_probability(df, {"rDPS": 50, "aDPS": 60}, encounter="e", job="c").collect()
    assert len(r) == 1 and (r[0].n, r[0].p_all, r[0].p_any) == (3, pytest.approx(1 / 3), pytest.approx(2 / 3))
    with pytest.raises(ValueError):
        an.joint_probability(df, {})


def plain_joint(h, k, rho):
    """P(X >= h, Y >= k) by summing the conditional tail over a fine grid of X."""
    if abs(rho) > 1 - 1e-12:
        tail = lambda z: 0.5 * math.erfc(z / math.sqrt(2))
        return tail(max(h, k)) if rho > 0 else max(0.0, tail(h) - tail(-k))
    x = np.linspace(h, max(h, 0) + 12, 400_001)
    tail = np.array([0.5 * math.erfc(v) for v in (k - rho * x[::40]) / math.sqrt(2 * (1 - rho * rho))])
    f = np.exp(-x[::40] ** 2 / 2) / math.sqrt(2 * math.pi) * tail
    return float(((f[1:] + f[:-1]) / 2 * np.diff(x[::40])).sum())


def test_joint_normal_tail_against_numerical_integration(spark):
    cases = [(h, k, r) for h in (-2.0, -0.3, 0.0, 0.4, 1.7) for k in (-1.1, 0.0, 0.4, 2.2)
             for r in (-1.0, -0.99, -0.6, 0.0, 0.3, 0.8, 0.95, 0.999, 1.0)]
    df = spark.createDataFrame(cases, "h double, k double, r double")
    for row in df.withColumn("p", an.joint_upper_tail(F.col("h"), F.col("k"), F.col("r"))).collect():
        assert row.p == pytest.approx(plain_joint(row.h, row.k, row.r), abs=1e-6), row


def test_joint_probability_has_the_normal_model(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(50, 10, 4000)
    y = 0.7 * x + rng.normal(20, 8, 4000)
    rows = [("e", "c", float(a), float(b)) for a, b in zip(x, y)] + [("e", "flat", 60.0, v) for v in (1.0, 99.0)] + [("e", "one", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "encounter_name string, class string, rDPS double, aDPS double")
    got = {r["class"]: r for r in an.joint_probability(df, {"rDPS": 55, "aDPS": 60}).collect()}
    h, k = (55 - x.mean()) / x.std(ddof=1), (60 - y.mean()) / y.std(ddof=1)
    rho = np.corrcoef(x, y)[0, 1]
    both = plain_joint(h, k, rho)
    assert got["c"].corr == pytest.approx(rho, abs=1e-9) and got["c"].normal_all == pytest.approx(both, abs=1e-6)
    assert got["c"].normal_any == pytest.approx(0.5 * math.erfc(h / 2 ** 0.5) + 0.5 * math.erfc(k / 2 ** 0.5) - both, abs=1e-6)
    assert abs(got["c"].normal_all - got["c"].p_all) < 0.02
    assert got["flat"].normal_all == pytest.approx(0.5 * math.erfc((60 - 50) / (98 / 2 ** 0.5) / 2 ** 0.5), abs=1e-6)
    assert got["one"].normal_all is None and got["one"].n == 1


def test_nearly_perfect_fit_keeps_its_residual(spark):
    rows = [(1e7 + i, 2 * (1e7 + i) + (1e-4 if i % 2 else -1e-4)) for i in range(1000)]
    df = spark.createDataFrame(rows, "x double, y double")
    line = spark.createDataFrame([(2.0, 0.0)], "m double, b double")
    assert an.r_squared(df, line, "x", "y").first().sse_reg == pytest.approx(1000 * 1e-8, rel=1e-3)


def test_pairs_and_points_edges(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None)], "x double, y double")
    fit = an.least_squares(df, "x", "y")
    assert fit.first().n == 2
    with pytest.raises(ValueError):
        an.fit_points(fit, df, "x", points=0)
    assert an.fit_points(fit, df, "x", points=1).count() == 1


def test_damage_probability_against_erfc(spark):
    vals = [10.0, 20.0, 35.0, 50.0, 55.0, 70.0, 90.0]
    df = spark.createDataFrame([("e", "c", v) for v in vals], "encounter_name string, class string, rDPS double")
    r = an.damage_probability(df, 50.0).first()
    mean, sd = np.mean(vals), np.std(vals, ddof=1)
    assert r.empirical == pytest.approx(4 / 7)
    want = 0.5 * math.erfc((50.0 - mean) / sd / math.sqrt(2))
    assert r.normal_tail == pytest.approx(want, abs=1e-6)
    with pytest.raises(ValueError):
        an.damage_probability(df, 60_000.0)


def test_degenerate_groups_do_not_fail(spark):
    """Constant y gives SSE(mean) = 0 and a constant measure gives sd = 0: both are answered
    (R^2 NULL, point-mass tail) instead of failing the query under ANSI division."""
    df = spark.createDataFrame([("c", 1.0, 5.0), ("c", 2.0, 5.0), ("one", 3.0, 7.0)], "g string, x double, y double")
    fit = an.least_squares(df, "x", "y", ["g"])
    r2 = {r.g: r for r in an.r_squared(df, fit.fillna(0.0, ["m", "b"]), "x", "y", ["g"]).collect()}
    assert r2["c"].sse_base == 0.0 and r2["c"].r2 is None and r2["one"].r2 is None
    rep = an.fit_report(df, "x", "y", ["g"]).collect()
    assert all(r.r2 is None for r in rep)
    dmg = spark.createDataFrame([("e", "k", 60.0), ("e", "k", 60.0), ("e", "low", 10.0), ("e", "low", 10.0)],
                                "encounter_name string, class string, rDPS double")
    tails = {r["class"]: r.normal_tail for r in an.damage_probability(dmg, 50.0).collect()}
    assert tails == {"k": 1.0, "low": 0.0}
    same_x = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "x double, y double")
    pts = an.fit_points(an.least_squares(same_x, "x", "y"), same_x, "x", points=5)
    line = an.line_from_points(pts).first()
    assert line.m is None and line.b is None


def test_normal_tail_expression_accuracy(spark):
    zs = [z / 4 for z in range(-16, 17)]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = [r.p for r in df.select(an.normal_upper_tail(F.col("z")).alias("p")).collect()]
    for z, p in zip(zs, got):
        assert p == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), abs=2e-7)
