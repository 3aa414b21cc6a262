"""Mixing sources to target weights by subset-sum budget fitting.

Every source has a target number of words. Whole passes over a source are taken first; what is
left of its target, less than one pass, is its *budget*, and a set of its documents is wanted
whose lengths add up to it:

1. Documents are counted by (source, exact length). The lengths of one source are at most
   sqrt(2 * words) many, since distinct lengths add up to no more than its words.
2. From the shortest length to the longest every length gives its share of documents, rounded
   so that all shares up to any length are right to one document (the start is seeded). The
   sum is then within about two of the longest documents of the budget.
3. What is missing (after putting back long documents where too much was taken) is fitted by
   bounded-knapsack dynamic programming over the documents left of each length, their numbers
   split into powers of two: the reachable sum nearest to the budget. Where a source has too few
   documents for that, they may be taken more than once, within the limit.
4. For every (source, length) the wanted number of documents is selected by a seeded hash of
   the id: whole hash blocks, and one numbered block in which the number falls, so neither a hot
   source nor a hot length meets in one task.

Steps 1 and 4 are DataFrame aggregates, joins and windows; step 3 runs once per source on its
table of lengths.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordinal import with_ordinal
from .frames import cut, ship

WORD = "[^\\x20\\x09-\\x0D]+"
#: Weights of the sources, repeating; most times that a document is taken.
WEIGHTS, MOST = (1, 2, 3), 3
SEED = 13
#: Largest budget that the dynamic programme works on; larger ones are filled by long documents first.
SPAN = 1 << 18
#: Times that documents are put back to close a gap.
TRIES = 6
#: Bits of the row hash that name a band of blocks, and a block; repeated rows that one array lists.
BAND_BITS, BLOCK_BITS, RUN = 6, 12, 1 << 16


# ------------------------------------------------------------------ targets
def shares(sources: DataFrame, most: int = MOST) -> tuple[Fraction, int]:
    """(level, words) for a table of ``words`` and ``weight`` by source: with the target
    min(most * words, level * weight) the sources share all words. Starts from the level without
    limits; the sources beyond theirs are counted out and the level of the others rises, until no
    further one is beyond. Each round is one aggregate; four numbers reach the driver."""
    whole = sources.agg(F.sum("words").alias("words"), F.sum("weight").alias("weight")).first()
    total = whole.words or 0
    if not total:
        return Fraction(0), 0
    level, held = Fraction(total, whole.weight), -1
    while True:
        over = _over(level, most)
        row = sources.agg(F.count_if(over).alias("n"), F.sum(F.when(over, F.col("words"))).alias("words"),
                          F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()
        if row.n == held or not row.weight:
            return level, total
        held = row.n
        level = Fraction(total - most * (row.words or 0), row.weight)


def _over(level: Fraction, most: int):
    """most * words < level * weight, exactly."""
    words, weight = (F.col(c).cast("decimal(38,0)") for c in ("words", "weight"))
    return words * F.lit(most * level.denominator).cast("decimal(38,0)") < weight * F.lit(level.numerator).cast("decimal(38,0)")


# ------------------------------------------------------------------ subset sums
def nearest_sum(lengths: np.ndarray, spare: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length (at most ``spare``) to take so that the words come as near to
    ``budget`` as any choice does; of two equally near sums the smaller one. Bounded knapsack: the
    number of a length is split into powers of two, and every reachable sum up to twice the
    budget remembers the first item that reached it."""
    out = np.zeros(len(lengths), np.int64)
    if budget <= 0:
        return out
    limit = 2 * budget   # a sum beyond is worse than none at all
    first = np.full(limit + 1, -1, np.int32)
    first[0] = 0
    items: list[tuple[int, int]] = [(0, 0)]   # (length number, documents)
    for at in np.argsort(-lengths, kind="stable"):
        size, left, step = int(lengths[at]), int(min(spare[at], limit // max(1, int(lengths[at])))), 1
        while size > 0 and left > 0 and first[budget] < 0:
            n = min(step, left)
            new = np.flatnonzero((first[:limit + 1 - n * size] >= 0) & (first[n * size:] < 0)) + n * size
            first[new] = len(items)
            items.append((int(at), n))
            left, step = left - n, 2 * step
        if first[budget] >= 0:
            break
    reached = np.flatnonzero(first >= 0)
    s = int(reached[np.argmin(np.abs(reached - budget))])
    while s:
        at, n = items[first[s]]
        out[at] += n
        s -= n * int(lengths[at])
    return out


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, offset: float, span: int = SPAN,
               most: int = 1) -> np.ndarray:
    """How many documents of each length (ascending, distinct) make up ``budget`` words, out of
    ``counts``. ``offset`` in [0, 1) starts the rounding. Where a gap is left because a source has
    too few documents, each may be taken up to ``most`` times."""
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    words = int((lengths * counts).sum())
    if budget <= 0 or not words:
        return np.zeros(len(lengths), np.int64)
    if budget >= words:
        return np.where(lengths > 0, counts, 0)
    # a share of each length: the rounded numbers up to each length follow the exact ones
    upto = np.floor(np.cumsum(counts).astype(np.float64) * (budget / words) + offset).astype(np.int64)
    take = np.clip(np.diff(upto, prepend=0), 0, counts)
    take[lengths == 0] = 0
    left = budget - int((lengths * take).sum())
    # too much: put back the longest; far too little: add the longest that fit
    for at in range(len(lengths) - 1, -1, -1):
        size = int(lengths[at])
        if left < 0:
            n = min(int(take[at]), -(left // size) if size else 0)
            take[at] -= n
            left += n * size
        if left > span and size:
            n = min(int(counts[at] - take[at]), left // size)
            take[at] += n
            left -= n * size
    best, gap, back = take.copy(), None, len(lengths) - 1
    for _ in range(TRIES + 1):
        fitted = take + nearest_sum(lengths, counts - take, left) if left <= span else take
        miss = abs(budget - int((lengths * fitted).sum()))
        if gap is None or miss < gap:
            best, gap = fitted, miss
        # a gap is left: give the programme more to choose from by putting back documents
        while back >= 0 and (not take[back] or left + int(lengths[back]) > span):
            back -= 1
        if not gap or back < 0:
            break
        n = min(int(take[back]), max(1, (span - left) // (4 * int(lengths[back]))))
        take[back] -= n
        left += n * int(lengths[back])
    if gap and budget <= span:
        fitted = nearest_sum(lengths, counts * most, budget)
        best = fitted if abs(budget - int((fitted * lengths).sum())) < gap else best
    return best


def _fit_sources(table: DataFrame, seed: int, most: int) -> DataFrame:
    """``rank, size, chosen`` from ``rank, size, n, passes, budget``: one task per source, over its
    lengths."""
    ship(table.sparkSession)

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("size")
        rank = t["rank"][0].as_py()
        offset = np.random.default_rng([seed, rank]).random()
        chosen = fit_budget(t["size"].to_numpy(), t["n"].to_numpy(), t["budget"][0].as_py(), offset,
                            most=most - t["passes"][0].as_py())
        return pa.table({"rank": t["rank"], "size": t["size"], "chosen": pa.array(chosen)})

    return table.groupBy("rank").applyInArrow(run, "rank long, size long, chosen long")


def _before(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``before``: the ``rows`` of a key's earlier blocks."""
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))


# ------------------------------------------------------------------ mix
def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """``doc_id, size`` (words of the text), ``source, source_size, target`` (of its source),
    ``copies`` (times the document is taken, 0 to ``most``) and ``taken`` (its words in the mix).

    The sources, by code point and null last, weigh ``weights`` in turn and share all words of the
    table; none gets more than ``most`` times its own, and what is beyond goes to the others by
    weight. A document of the source is taken for every whole pass of its target, and once more
    (in small sources more than once) when it is selected for the rest. Only the table and the seed decide, so reruns agree.

    A null text has size 0 and is never taken; a null id hashes as such; rows that are equal in
    id, size and source are told apart by their number only, so some of them may be taken once
    more than others; a source without words has target 0; other columns are ignored; an empty
    table gives no rows.
    """
    if not weights or any(w < 1 for w in weights) or most < 1:
        raise ValueError("weights and most must be positive")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                           F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
               .groupBy("source", "size", "doc_id").agg(F.count(F.lit(1)).alias("m")))
    lengths = cut(rows.groupBy("source", "size").agg(F.sum("m").alias("n")))
    sources = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    ranked = with_ordinal(sources, [], [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    ranked = cut(ranked.withColumn("weight", weight.cast("long")))
    level, _ = shares(ranked, most)
    # level * weight as a double; the exact budget in whole words, halves up
    ideal = F.col("weight") * F.lit(float(level.numerator)) / F.lit(float(level.denominator))
    limit = F.col("words") * most
    target = F.when(_over(level, most), limit.cast("double")).otherwise(ideal)
    aimed = ranked.withColumn("target", target).withColumn("aim", F.least(F.round("target").cast("long"), limit))
    plan = (aimed.withColumn("passes", F.expr("CASE WHEN words > 0 THEN aim div words ELSE 0L END"))
            .select("source", "rank", "words", "target", "passes", (F.col("aim") - F.col("passes") * F.col("words")).alias("budget")))
    plan = cut(plan)
    by_length = lengths.join(plan, lengths["source"].eqNullSafe(plan["source"]))
    chosen = _fit_sources(by_length.select("rank", "size", "n", "passes", "budget"), seed, most)
    wanted = cut(by_length.select(lengths["source"].alias("source_of"), "rank", "size", "n", "words", "target", "passes")
                 .join(chosen, ["rank", "size"]))

    hashed = rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "size", "source"))
    hashed = hashed.withColumn("block", F.shiftrightunsigned("h", 64 - BLOCK_BITS).cast("int"))
    # rows before each block of a (source, length): in earlier bands, and earlier in its band
    blocks = hashed.groupBy("source", "size", "block").agg(F.sum("m").alias("rows"))
    blocks = cut(blocks.withColumn("band", F.shiftright("block", BLOCK_BITS - BAND_BITS)))
    bands = _before(blocks.groupBy("source", "size", "band").agg(F.sum("rows").alias("rows")), ["source", "size"], "band")
    bands = bands.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("band").alias("b"), F.col("before").alias("band_before"))
    blocks = _before(blocks, ["source", "size", "band"], "block")
    blocks = (blocks.join(bands, blocks["source"].eqNullSafe(bands["s"]) & (blocks["size"] == bands["z"]) & (blocks["band"] == bands["b"]))
              .select(F.col("source").alias("source_of"), "size", "block", (F.col("before") + F.col("band_before")).alias("before")))
    blocks = (blocks.join(wanted, blocks["source_of"].eqNullSafe(wanted["source_of"]) & (blocks["size"] == wanted["size"]))
              .select(blocks["source_of"], blocks["size"].alias("size_of"), F.col("block").alias("block_of"), "before",
                      "n", "words", "target", "passes", "chosen"))
    placed = hashed.join(blocks, hashed["source"].eqNullSafe(blocks["source_of"]) & (hashed["size"] == blocks["size_of"])
                         & (hashed["block"] == blocks["block_of"]))
    within = (Window.partitionBy("source", "size", "block").orderBy("h", "doc_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    first = placed.withColumn("first", F.col("before") + F.coalesce(F.sum("m").over(within), F.lit(0)))
    runs = first.withColumn("run", F.explode(F.sequence(F.lit(0), F.expr(f"(m - 1) div {RUN}"))))
    each = F.sequence(F.col("run") * RUN, F.least(F.col("m"), (F.col("run") + 1) * RUN) - 1)
    copies = F.col("passes") + F.expr("chosen div n") + F.when(F.col("first") + F.col("k") < F.expr("chosen % n"), 1).otherwise(0)
    return (runs.withColumn("k", F.explode(each)).withColumn("copies", copies.cast("int"))
            .select("doc_id", "size", "source", F.col("words").alias("source_size"), "target", "copies",
                    (F.col("copies") * F.col("size")).cast("long").alias("taken")))
