"""Interaction audit of text filters: what each filter removes, in every order of application.

A document fails a set of filters, its *mask* of five bits. The rows of a part are counted by
mask, and from these counts the removals of all 32 coalitions of filters are tabulated: v(S) is
the number of rows that fail some filter of S. Whatever the order, after the filters S exactly
v(S) rows are gone; so the step that adds f to S removes v(S + f) - v(S), and the counts of all
600 steps are differences of coalitions.

Shapley values come from the same table by constrained least squares: the additive attribution
phi that fits v best under the kernel weights (n - 1) / (C(n, s) s (n - s)), subject to the
phi adding up to v of all filters. Its normal equations (with one multiplier for the
constraint) are solved once, in rationals, for the 32 unit tables; this gives the attribution
as fixed fractions of the 32 removals, exact integers when summed over the 120 orders.

Everything after the masks is a handful of small integers per part, computed by DataFrame
expressions; texts are read once and never shuffled.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import cut

FILTERS = "ABCDE"
#: Words as runs outside ASCII white space, as the SQL has them.
WORD = "[^\\x20\\x09-\\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = "[#$%&*|]"
#: Thresholds: least words, least share of distinct words, largest share of capitals (percent).
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10


# ------------------------------------------------------------------ rationals
def solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """The solution X of matrix X = right, by elimination in rationals."""
    n = len(matrix)
    rows = [[Fraction(x) for x in a] + [Fraction(x) for x in b] for a, b in zip(matrix, right)]
    for c in range(n):
        pivot = next((r for r in range(c, n) if rows[r][c] != 0), None)
        if pivot is None:
            raise ValueError("the equations have no unique solution")
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(n):
            if r != c and rows[r][c] != 0:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c])]
    return [row[n:] for row in rows]


def attribution(n: int) -> list[list[Fraction]]:
    """``out[f][S]``: the weight of coalition S (a bit mask) in the Shapley value of filter f, as
    the constrained least-squares solution for the table that is 1 at S and 0 elsewhere."""
    full = (1 << n) - 1
    normal = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [[Fraction(0)] * (full + 1) for _ in range(n + 1)]
    for s in range(1, full):
        size = bin(s).count("1")
        weight = Fraction(n - 1, comb(n, size) * size * (n - size))
        inside = [i for i in range(n) if s >> i & 1]
        for i in inside:
            right[i][s] += weight
            for j in inside:
                normal[i][j] += weight
    for i in range(n):       # the multiplier of the constraint, and the constraint itself
        normal[i][n] = normal[n][i] = Fraction(1)
    right[n][full] = Fraction(1)
    if n == 1:               # no proper coalition: the constraint alone decides
        return [[Fraction(0), Fraction(1)]]
    return solve(normal, right)[:n]


def order_sums(n: int) -> list[list[int]]:
    """The attribution summed over all n! orders: whole numbers."""
    out = [[x * factorial(n) for x in row] for row in attribution(n)]
    if any(x.denominator != 1 for row in out for x in row):
        raise ArithmeticError("the attribution over all orders is not whole")
    return [[int(x) for x in row] for row in out]


# ------------------------------------------------------------------ masks
def conditions(text: Column) -> list[Column]:
    """Whether a text fails A (few words), B (repeated words), C (capitals) and D (signs)."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    count, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return [count < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * count, 100 * capitals > MOST_CAPITALS * F.length(text),
            text.rlike(SIGNS)]


def failures(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``doc_id, part, mask, n``: rows by id, part and failed filters (bit i for filter i).

    E needs the smallest id of every text. Texts stand as their SHA-256; a text's smallest id is
    one row by a map-side aggregate, however many copies it has, and is joined back on the text
    *and* the id, so the copies of a frequent text are dealt by their ids. Repeated rows are
    counted before they are sent.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    first = F.lit(0)
    for i, failed in enumerate(conditions(F.col("_t"))):
        first = first + F.when(failed, 1 << i).otherwise(0)
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        text.alias("_t"))
            .select("doc_id", "part", first.alias("mask"), F.unhex(F.sha2(F.col("_t").cast("binary"), 256)).alias("digest"))
            .groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n")))
    rows = cut(rows)   # narrow; read twice, the texts once
    least = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    found = rows.join(least.withColumn("least", F.lit(True)), ["digest", "doc_id"], "left")
    later = F.col("doc_id").isNotNull() & F.col("least").isNull()
    return found.select("doc_id", "part", (F.col("mask") + F.when(later, 1 << 4).otherwise(0)).alias("mask"), "n")


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                quality_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """``part, mask, n, good, toxic``: rows, those labelled good and those labelled toxic. Several
    labels of one id count as one: it is good (toxic) when one of them says so."""
    marks = (labels.select(F.col(id_col).cast("long").alias("doc_id"), (F.col(quality_col) == 1).alias("good"),
                           (F.col(toxic_col) == 1).alias("toxic"))
             .where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    joined = failures(docs, id_col, text_col, part_col).join(marks, "doc_id", "left")
    # one row per part and mask, read three times below
    return cut(joined.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")))


# ------------------------------------------------------------------ audit
def coalitions(counts: DataFrame, filters: int = len(FILTERS)) -> DataFrame:
    """``part, total, removals, fails, alone``: for every part, the array ``removals`` of all
    2 ** filters coalitions in order of their mask (``removed``, ``good``, ``toxic``), the rows
    that fail each filter, and those that fail it only. The arrays have a fixed size."""
    each = counts.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit((1 << filters) - 1))))
    hit = F.col("s").bitwiseAND(F.col("mask")) != 0
    table = each.groupBy("part", "s").agg(
        *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(a) for c, a in (("n", "removed"), ("good", "good"), ("toxic", "toxic"))])
    table = table.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("s", "removed", "good", "toxic"))).alias("removals"))
    single = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0, F.col("n")).otherwise(0)) for i in range(filters)]).alias("fails"),
        F.array(*[F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(filters)]).alias("alone"))
    return table.join(single, "part")


def audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """One row per part, order of the filters (``filter_order``) and ``step``: ``kept`` after it,
    ``removed`` in it, ``redundant`` (fail its filter but were removed before), ``unique_fails``
    (fail its filter only), ``good_lost`` and ``toxic_lost`` (removed here, labelled so) and
    ``shapley`` (its filter's ``removed`` summed over all orders). ``columns``: see
    :func:`mask_counts`.

    Parts are the values of the part column, null as the empty text. A null text is empty: it
    fails A and no other but E. E compares ids: of rows with equal texts, those with the smallest
    id (all of them, if it repeats) pass; a row without an id passes and is nobody's original.
    A part always has all its rows, zeros included; an empty table gives none; labels of absent
    documents, null labels and other columns are ignored.
    """
    n = len(FILTERS)
    weights = F.array(*[F.array(*[F.lit(x).cast("long") for x in row]) for row in order_sums(n)])
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    table = coalitions(mask_counts(docs, labels, **columns), n)
    # each filter's value, once per part: the removals weighted by its row of whole numbers
    shapley = F.transform(weights, lambda w: F.aggregate(
        F.zip_with(w, F.col("removals"), lambda a, b: a * b["removed"]), F.lit(0).cast("long"), lambda a, b: a + b))
    steps = (table.withColumn("shapley", shapley)
             .select("*", F.explode(orders).alias("filter_order"))
             .select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")))
    before = F.lit(0)
    for i, name in enumerate(FILTERS):
        at = F.instr("filter_order", name)
        before = before + F.when(at < F.col("step"), 1 << i).otherwise(0)
    # the filter of a step is the place of its letter among the filters
    steps = steps.withColumns({"before": before, "filter": F.expr(f"instr('{FILTERS}', substring(filter_order, step, 1))")})
    after = F.col("before") + F.element_at(F.array(*[F.lit(1 << i) for i in range(n)]), F.col("filter"))
    steps = steps.withColumns({"then": F.element_at("removals", after + 1), "at": F.element_at("removals", F.col("before") + 1)})
    removed = F.col("then.removed") - F.col("at.removed")
    return steps.select(
        "part", "filter_order", "step", (F.col("total") - F.col("then.removed")).alias("kept"), removed.alias("removed"),
        (F.element_at("fails", F.col("filter")) - removed).alias("redundant"), F.element_at("alone", F.col("filter")).alias("unique_fails"),
        (F.col("then.good") - F.col("at.good")).alias("good_lost"), (F.col("then.toxic") - F.col("at.toxic")).alias("toxic_lost"),
        F.element_at("shapley", F.col("filter")).alias("shapley"))
