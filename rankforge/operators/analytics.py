"""Fit and tail-probability analytics, computed as aggregates: only one row per group ever
reaches the driver (the source notebook pulled the whole table into pandas).

Inputs are cast to double before any sum (32-bit amounts squared in float lose digits).
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import prepare
from .ordinal import with_ordinal

# Abramowitz-Stegun 7.1.26 coefficients for erfc (|error| < 1.5e-7).
AS_P = 0.3275911
AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)

DEFAULT_SEED = 42
DEFAULT_SAMPLE = 100

# Fixed value: hex digits of a hash, 60 bits, so its remainder by any row count is even.
HASH_DIGITS = 15

#: Leading bits of a hash that name a block of rows, and a band of blocks.
BLOCK_BITS, BAND_BITS = 16, 8

#: Rows of a block that may be numbered in one task.
IN_BLOCK = 1_000_000

# Positive nodes and weights of the ten-point Gauss-Legendre rule.
GL_NODES = (0.1488743389816312, 0.4333953941292472, 0.6794095682990244, 0.8650633666889845, 0.9739065285171717)
GL_WEIGHTS = (0.2955242247147529, 0.2692667193099963, 0.2190863625159821, 0.1494513491505806, 0.0666713443086881)

#: Panels of the joint tail: the angles from a right angle down, halved so many times.
PANELS = 22


def _d(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


# ------------------------------------------------------------------ L1 / L7 / D7
def select_features(gold: DataFrame, columns: list[str], where: dict | None = None) -> DataFrame:
    """Projection of the analysis columns, optionally an equality filter per column
    (pushed down to the scan when the input is a table)."""
    out = gold
    for c, v in (where or {}).items():
        out = out.where(F.col(c) == F.lit(v))
    return out.select(*columns)


# ------------------------------------------------------------------ L2
def _hash60(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("bigint")


def draw_position(seed: int, i: Column, rows: Column) -> Column:
    """Position that draw ``i`` takes among ``rows`` rows: a 60-bit hash of ``seed:i`` modulo
    the row count."""
    return _hash60(F.concat(F.lit(f"{seed}:"), i.cast("string"))) % rows


def _exact(df: DataFrame, columns) -> list[str]:
    """Those of the columns whose text is the same everywhere (no fractions, no nesting)."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in columns if isinstance(kinds[c], (T.IntegralType, T.StringType, T.DateType, T.BooleanType))]


def bootstrap_sample(df: DataFrame, key: list[str], n: int = DEFAULT_SAMPLE, seed: int = DEFAULT_SEED,
                     draw_col: str = "draw", tie: list[str] = ()) -> DataFrame:
    """Exactly ``n`` rows drawn with replacement (none from an empty frame), whatever the keys.

    Rows are ordered by a seeded hash of their key and of those ``tie`` columns that are whole
    numbers, texts, dates or booleans, then by key, ``tie`` and the other columns. Draw ``i`` takes
    position ``hash(seed:i) mod N`` of this order. The order is cut into blocks by the leading bits
    of the hash: their counts (at most 2^16 numbers, which the driver keeps) split the draws over
    the blocks, and only rows of drawn blocks are kept and numbered: block by block, or, if the
    largest block has more than ``IN_BLOCK`` rows (as with few keys), over as many partitions as
    they need, so neither the table nor a key that fills a block is sorted in one task. Rows that
    are equal in all columns are interchangeable. The sample is checkpointed: two passes over
    ``df``, none for what reads it.
    """
    if n < 0:
        raise ValueError("sample size must be >= 0")
    spark = prepare(df.sparkSession)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in [*key, *_exact(df, tie)]]
    block = F.shiftright(F.col("_h"), 4 * HASH_DIGITS - BLOCK_BITS).cast("int")
    hashed = df.withColumn("_h", _hash60(F.concat_ws("|", F.lit(str(seed)), *parts))).withColumn("_b", block)
    sizes = sorted((r["_b"], r["_n"]) for r in hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).collect())
    total = sum(m for _, m in sizes)
    if not total or not n:
        return df.limit(0).select(F.lit(0).cast("long").alias(draw_col), "*")
    bands: dict[int, list[tuple[int, int]]] = {}   # band -> (rows of the band before the block, block)
    starts, before = [], 0                         # rows before each band
    for b, m in sizes:
        found = bands.setdefault(b >> (BLOCK_BITS - BAND_BITS), [])
        if not found:
            starts.append(before)
        found.append((before - starts[-1], b))
        before += m
    blocks = pa.array([[{"_before": x, "_b": b} for x, b in found] for found in bands.values()],
                      pa.list_(pa.struct([("_before", pa.int64()), ("_b", pa.int32())])))
    inside = F.broadcast(spark.createDataFrame(pa.table({"_band": pa.array(bands, pa.int32()), "_blocks": blocks})))
    draws = spark.range(n).select(F.col("id").alias(draw_col), draw_position(seed, F.col("id"), F.lit(total)).alias("_p"))
    firsts, names = (F.expr(f"array({', '.join(f'{x}{kind}' for x in values)})") for values, kind in ((starts, "L"), (bands, "")))
    draws = draws.withColumn("_nth", F.size(F.filter(firsts, lambda x: x <= F.col("_p")))).select(
        draw_col, F.element_at(names, F.col("_nth")).alias("_band"), (F.col("_p") - F.element_at(firsts, F.col("_nth"))).alias("_off"))
    found = F.element_at(F.filter("_blocks", lambda x: x["_before"] <= F.col("_off")), -1)
    draws = (draws.join(inside, "_band").withColumn("_found", found)
             .select(draw_col, F.col("_found._b").alias("_block"), (F.col("_off") - F.col("_found._before")).alias("_at")))
    rest = [f.name for f in df.schema.fields if f.name not in {*key, *tie} and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    drawn = hashed.join(draws.select(F.col("_block").alias("_b")).distinct(), "_b", "left_semi").withColumn("_salt", F.rand(seed))
    order = ["_h", *key, *tie, *rest, "_salt"]
    if max(m for _, m in sizes) <= IN_BLOCK:
        number = F.row_number().over(Window.partitionBy("_b").orderBy(*order)).cast("bigint") - 1
        placed = drawn.withColumn("_pos", number)
    else:
        placed = with_ordinal(drawn, ["_b"], order, "_pos")
    chosen = draws.join(placed, (F.col("_block") == F.col("_b")) & (F.col("_at") == F.col("_pos")))
    return chosen.select(draw_col, *df.columns).checkpoint()


def _keys(df: DataFrame, group) -> tuple[DataFrame, list[str]]:
    """Group columns, or a constant one-value key when the statistic is global, so that
    every per-group table joins back on an equality key."""
    group = list(group)
    if group:
        return df, group
    return df.withColumn("_all", F.lit(0)), ["_all"]


def _drop_all(df: DataFrame) -> DataFrame:
    return df.drop("_all") if "_all" in df.columns else df


# ------------------------------------------------------------------ L3
def least_squares(df: DataFrame, x: str, y: str, group: list[str] = (),
                  round_decimal: int | None = None) -> DataFrame:
    """Slope ``m`` and intercept ``b`` per group: m = cov(x,y)/var(x), b = E[y] - m E[x].
    ``round_decimal`` 0 or None leaves them unrounded; rounding is half-to-even. A constant
    x gives NULL; ``n`` counts the pairs without a NULL. One partial/final aggregate: a hot group is pre-aggregated map-side."""
    return df.groupBy(*group).agg(*_line_aggs(x, y, round_decimal))


def _line_aggs(x: str, y: str, round_decimal: int | None) -> list[Column]:
    m = F.regr_slope(_d(y), _d(x))
    b = F.regr_intercept(_d(y), _d(x))
    if round_decimal:
        m, b = F.bround(m, round_decimal), F.bround(b, round_decimal)
    return [m.alias("m"), b.alias("b"), F.regr_count(_d(y), _d(x)).alias("n")]


# ------------------------------------------------------------------ L4
def _squares(df: DataFrame, line: DataFrame, x: str, y: str, keys: list[str]) -> DataFrame:
    """``keys, m, b, sse_base, sse_reg`` per group: the squared distances of y from its mean and
    of the pairs from the line, summed directly (no difference of large sums, so a nearly
    perfect fit keeps its digits). The one-row-per-group line is joined to the rows (NULL keys
    match each other); adaptive execution broadcasts it or splits a hot group."""
    named = line.select(*[F.col(k).alias(f"_f{i}") for i, k in enumerate(keys)], "m", "b")
    rows = df.select(*keys, _d(x).alias("_x"), _d(y).alias("_y"))
    joined = rows.join(named, [rows[k].eqNullSafe(named[f"_f{i}"]) for i, k in enumerate(keys)])
    residual = F.col("_y") - (F.col("m") * F.col("_x") + F.col("b"))
    return joined.groupBy(*keys, "m", "b").agg(
        (F.count("_y") * F.var_pop("_y")).alias("sse_base"), F.sum(residual * residual).alias("sse_reg"))


def _r2(decimals: int) -> Column:
    """NULL when SSE(mean) is 0 (constant y): R^2 is undefined there."""
    ratio = F.try_divide(F.col("sse_reg"), F.col("sse_base"))
    return (F.bround(1 - ratio, decimals) + F.lit(0.0)).alias("r2")


def r_squared(df: DataFrame, fit: DataFrame, x: str, y: str, group: list[str] = (),
              decimals: int = 2) -> DataFrame:
    """R^2 = 1 - SSE(line)/SSE(mean) of a *given* line (m, b) per group, half-to-even
    rounded, with both sums of squares."""
    data, keys = _keys(df, group)
    line, _ = _keys(fit, group)
    out = _squares(data, line, x, y, keys).withColumn("r2", _r2(decimals))
    return out if group else _drop_all(out)


# ------------------------------------------------------------------ L5
def fit_points(fit: DataFrame, data: DataFrame, x: str, group: list[str] = (),
               points: int = 100) -> DataFrame:
    """``points`` evenly spaced x in [min x, max x] per group and y = m x + b; the points
    are generated from the one-row-per-group line, no join with a point table."""
    if points < 1:
        raise ValueError("points must be >= 1")
    d, keys = _keys(data, group)
    f, _ = _keys(fit, group)
    rng = d.groupBy(*keys).agg(F.min(_d(x)).alias("_lo"), F.max(_d(x)).alias("_hi"))
    lines = f.select(*keys, "m", "b").join(rng, keys)
    step = (F.col("_hi") - F.col("_lo")) / F.lit(max(points - 1, 1))
    out = lines.select(*keys, "m", "b", "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    out = out.select(*keys, "i", (F.col("_lo") + F.col("i") * step).alias("x"), "m", "b")
    out = out.select(*keys, "i", "x", (F.col("m") * F.col("x") + F.col("b")).alias("y"))
    return out if group else _drop_all(out)


# ------------------------------------------------------------------ L6
def line_from_points(points: DataFrame, group: list[str] = ()) -> DataFrame:
    """Line through the first and last drawn point: m = dy/dx, b = y0 - m x0 (NULL when all
    points share one x)."""
    aggs = [F.min("x").alias("x0"), F.max("x").alias("x1"),
            F.min_by("y", "x").alias("y0"), F.max_by("y", "x").alias("y1")]
    ends = points.groupBy(*group).agg(*aggs)
    m = F.try_divide(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))
    return ends.select(*group, m.alias("m"), (F.col("y0") - m * F.col("x0")).alias("b"))


# ------------------------------------------------------------------ L8
def normal_upper_tail(z: Column) -> Column:
    """P(Z >= z) for a standard normal, as a plain Column expression (A-S 7.1.26)."""
    t = 1 / (1 + F.lit(AS_P) * F.abs(z) / F.lit(math.sqrt(2.0)))
    poly = F.lit(AS_A[4])
    for a in reversed(AS_A[:4]):
        poly = poly * t + F.lit(a)
    half_erfc = F.lit(0.5) * poly * t * F.exp(-z * z / 2)
    return F.when(z >= 0, half_erfc).otherwise(1 - half_erfc)


def damage_probability(df: DataFrame, x: float, measure: str = "rDPS",
                       group: list[str] = ("encounter_name", "class")) -> DataFrame:
    """Probability that a group reaches at least ``x`` of ``measure``: the empirical share
    of rows with value >= x, and the normal-model tail 1 - Phi((x - mean) / sd)."""
    if not (0 <= x <= 50_000):
        raise ValueError("x must lie in [0, 50000]")
    v = _d(measure)
    stats = df.groupBy(*group).agg(
        F.avg((v >= F.lit(x)).cast("double")).alias("empirical"),
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"), F.count(v).alias("n"))
    z = F.try_divide(F.lit(float(x)) - F.col("mean"), F.col("sd"))
    # sd 0 (all values equal): the normal model degenerates to a point mass at the mean
    tail = F.when(F.col("sd") == 0, (F.col("mean") >= F.lit(float(x))).cast("double")).otherwise(normal_upper_tail(z))
    return stats.withColumn("normal_tail", tail)


def joint_upper_tail(h: Column, k: Column, rho: Column) -> Column:
    """P(X >= h, Y >= k) of two standard normals with correlation ``rho``, as a Column expression.

    For rho >= 0 it is the product of the tails plus 1 / (2 pi) times the integral over u, from
    acos(rho) to a right angle, of exp(-((h - k)^2 + 4 h k sin^2(u / 2)) / (2 sin^2 u)). The range
    is cut into panels that halve towards 0, where the integrand may drop steeply, with ten
    Gauss-Legendre points each. For rho < 0 one variable is turned round."""
    rho = F.greatest(F.least(rho, F.lit(1.0)), F.lit(-1.0))
    turned = F.when(rho < 0, -k).otherwise(k)
    low = F.acos(F.abs(rho))
    panels = [(math.pi / 2 ** (j + 2) if j + 1 < PANELS else 0.0, math.pi / 2 ** (j + 1)) for j in range(PANELS)]
    rule = [(s * x, w) for x, w in zip(GL_NODES, GL_WEIGHTS) for s in (-1.0, 1.0)]
    named = ("named_struct(" + ", ".join(f"'{n}', {v!r}D" for n, v in zip(("bottom", "top", "node", "weight"), (*ends, *at))) + ")"
             for ends in panels for at in rule)
    points = F.expr(f"array({', '.join(named)})")

    def term(p: Column) -> Column:
        a, b = F.greatest(p["bottom"], low), F.greatest(p["top"], low)
        u = (a + b) / 2 + (b - a) / 2 * p["node"]
        gap = (h - turned) * (h - turned) + 4 * h * turned * F.pow(F.sin(u / 2), 2)
        return F.when(b > a, (b - a) / 2 * p["weight"] * F.exp(-gap / (2 * F.pow(F.sin(u), 2)))).otherwise(0.0)

    area = F.aggregate(points, F.lit(0.0), lambda total, p: total + term(p))
    both = normal_upper_tail(h) * normal_upper_tail(turned) + area / (2 * math.pi)
    return F.when(rho < 0, normal_upper_tail(h) - both).otherwise(both)


def joint_probability(df: DataFrame, thresholds: dict[str, float], encounter: str | None = None,
                      job: str | None = None, group: list[str] = ("encounter_name", "class")) -> DataFrame:
    """Per group, the share of rows that reach every threshold (``p_all``) and that reach at
    least one (``p_any``), with the rows (``n``) in which all measures are present; optionally
    of one encounter and one job. A NULL measure takes its row out.

    For two measures also the normal model: their correlation (``corr``) and the probabilities
    ``normal_all`` and ``normal_any`` of a bivariate normal with the measured means, deviations and
    correlation. A measure without spread is a point mass; a group of one row has no model."""
    if not thresholds or any(not (0 <= t <= 50_000) for t in thresholds.values()):
        raise ValueError("each threshold must lie in [0, 50000]")
    where = {"encounter_name": encounter, "class": job}
    rows = df
    for column, value in where.items():
        if value is not None:
            rows = rows.where(F.col(column) == F.lit(value))
    reached = [_d(m) >= F.lit(float(t)) for m, t in thresholds.items()]
    every, some = reached[0], reached[0]
    for r in reached[1:]:
        every, some = every & r, some | r
    present = rows.where(F.expr(" AND ".join(f"`{m}` IS NOT NULL" for m in thresholds)))
    aggs = [F.avg(every.cast("double")).alias("p_all"), F.avg(some.cast("double")).alias("p_any"), F.count(F.lit(1)).alias("n")]
    if len(thresholds) != 2:
        return present.groupBy(*group).agg(*aggs)
    (x, at_x), (y, at_y) = thresholds.items()
    spread = [F.avg(_d(x)).alias("_mx"), F.stddev_samp(_d(x)).alias("_sx"), F.avg(_d(y)).alias("_my"), F.stddev_samp(_d(y)).alias("_sy"),
              F.covar_samp(_d(x), _d(y)).alias("_cov")]
    stats = present.groupBy(*group).agg(*aggs, *spread).withColumn("corr", F.try_divide(F.col("_cov"), F.col("_sx") * F.col("_sy")))
    tails = {}
    for c, at in (("x", at_x), ("y", at_y)):
        mean, sd = F.col(f"_m{c}"), F.col(f"_s{c}")
        tails[f"_z{c}"] = F.try_divide(F.lit(float(at)) - mean, sd)
        tails[f"_t{c}"] = F.when(sd == 0, (mean >= at).cast("double")).otherwise(normal_upper_tail(F.try_divide(F.lit(float(at)) - mean, sd)))
    stats = stats.withColumns(tails)
    flat = (F.col("_sx") == 0) | (F.col("_sy") == 0)
    both = F.when(flat, F.col("_tx") * F.col("_ty")).otherwise(joint_upper_tail(F.col("_zx"), F.col("_zy"), F.col("corr")))
    return (stats.withColumn("normal_all", both).withColumn("normal_any", F.col("_tx") + F.col("_ty") - F.col("normal_all"))
            .select(*group, "p_all", "p_any", "n", "corr", "normal_all", "normal_any"))


# ------------------------------------------------------------------ L9
def fit_report(sample: DataFrame, x: str, y: str, group: list[str] = (),
               round_decimal: int = 2) -> DataFrame:
    """Slope, intercept (rounded as the caller asks), R^2 of that line, both SSEs and the
    pairs per group."""
    data, keys = _keys(sample, group)
    line = data.groupBy(*keys).agg(*_line_aggs(x, y, round_decimal))
    squares = _squares(data, line, x, y, keys)
    n = line.select(*[F.col(k).alias(f"_f{i}") for i, k in enumerate(keys)], "n")
    out = squares.join(n, [squares[k].eqNullSafe(n[f"_f{i}"]) for i, k in enumerate(keys)])
    out = out.select(*keys, "m", "b", "sse_base", "sse_reg", _r2(2), "n")
    return out if group else _drop_all(out)
