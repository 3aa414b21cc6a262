"""Distributed ordinals and running totals: the position of each row in a sort order
without one-task windows.

``row_number()`` over a global order (or over a key that holds a third of the data) runs in
one task. Here the rows are range-partitioned on (keys, order) -- so a hot key is spread
over many partitions -- sorted inside each partition, and tagged with
(partition id, local position). A tiny table with one row per (partition, key) gives each
partition's running offset inside a key; adding it gives the exact ordinal.

The range bounds come from a sample, and the rows reaching a partition come out of an
upstream shuffle in fetch order, so two evaluations of the tagged frame need not agree.
The tagged frame is therefore checkpointed (reliable checkpoint in the shared
``spark.checkpoint.dir``) before it is read twice; only the columns the caller passes are
written, so callers narrow first.

The offsets table has at most (#partitions + #keys) rows. Without keys it has one row per
partition, a proven bound, so it is broadcast; with keys adaptive execution picks the join
from its measured size.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import prepare, shuffle_partitions

SEED = 42
_LOCAL_BITS = 33  # monotonically_increasing_id = partition id << 33 | position in partition


def _cols(names):
    return [F.col(c) if isinstance(c, str) else c for c in names]


def tag_positions(df: DataFrame, keys: list[str], order: list[str | Column],
                  num_partitions: int | None = None) -> DataFrame:
    """Range-partition and sort on (keys, order); add ``_pid`` and ``_loc``. The result is
    checkpointed, so every later read sees the same partitioning."""
    prepare(df.sparkSession)
    n = num_partitions or shuffle_partitions(df.sparkSession)
    sort_cols = _cols(keys) + _cols(order)
    ranged = df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
    mid = F.monotonically_increasing_id()
    tagged = (ranged.withColumn("_mid", mid)
              .withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
              .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
              .drop("_mid"))
    return tagged.checkpoint(eager=True)


def partition_offsets(tagged: DataFrame, keys: list[str], value: str | None = None) -> DataFrame:
    """One row per (partition, key): rows there (``_cnt``), first local position
    (``_first``), rows of the same key in earlier partitions (``_before``) and, with
    ``value``, the sum of that column in earlier partitions (``_vbefore``)."""
    aggs = [F.count(F.lit(1)).alias("_cnt"), F.min("_loc").alias("_first")]
    if value:
        aggs.append(F.sum(value).alias("_vsum"))
    stats = tagged.groupBy("_pid", *keys).agg(*aggs)
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    out = stats.withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    if value:
        out = out.withColumn("_vbefore", F.coalesce(F.sum("_vsum").over(w), F.lit(0)))
    return out


def _join_offsets(tagged: DataFrame, offsets: DataFrame, keys: list[str], carry: list[str]):
    renamed = offsets.select("_pid", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *carry)
    if not keys:
        renamed = F.broadcast(renamed)  # one row per partition
    cond = [tagged["_pid"] == renamed["_pid"]]
    cond += [tagged[k].eqNullSafe(renamed[f"_k{i}"]) for i, k in enumerate(keys)]
    return tagged.join(renamed, on=cond, how="inner"), renamed


def with_ordinal(df: DataFrame, keys: list[str], order: list[str | Column], name: str = "ordinal",
                 num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of the row within its key in ``order`` (ascending
    columns; pass ``F.col(c).desc()`` for descending). Equal to
    ``row_number() OVER (PARTITION BY keys ORDER BY order) - 1`` for a unique order;
    NULL keys form their own group."""
    tagged = tag_positions(df, keys, order, num_partitions)
    offsets = partition_offsets(tagged, keys)
    joined, _ = _join_offsets(tagged, offsets, keys, ["_first", "_before"])
    ordinal = (F.col("_before") + F.col("_loc") - F.col("_first")).alias(name)
    return joined.select(*[tagged[c] for c in df.columns], ordinal)


def running_total(df: DataFrame, keys: list[str], order: list[str | Column], value: str,
                  name: str = "running_total", num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = sum of ``value`` over the rows *before* this one within its key in
    ``order`` (0 for the first). Partition offsets come from the small per-partition table;
    the part inside a partition is a window over (partition, key), which splits a hot key
    across all the partitions it spans."""
    tagged = tag_positions(df, keys, order, num_partitions)
    offsets = partition_offsets(tagged, keys, value)
    w = (Window.partitionBy("_pid", *keys).orderBy("_loc")
         .rowsBetween(Window.unboundedPreceding, -1))
    local = tagged.withColumn("_vlocal", F.coalesce(F.sum(value).over(w), F.lit(0)))
    joined, _ = _join_offsets(local, offsets, keys, ["_vbefore"])
    total = (F.col("_vbefore") + F.col("_vlocal")).alias(name)
    return joined.select(*[local[c] for c in df.columns], total)


#: Rows whose order values are sampled to estimate where a slice lies; rows that may be numbered
#: in one task.
SAMPLE, SORTED = 16_384, 1_000_000

_ORDER = re.compile(r"^\s*`?([^`]+?)`?(?:\s+(ASC|DESC))?(?:\s+NULLS\s+(FIRST|LAST))?\s*$", re.IGNORECASE)


def _directions(order: list[str | Column]) -> list[tuple[str, bool, bool]]:
    """(column, descending, nulls first) of each order term: a name, SQL such as ``v DESC NULLS
    LAST``, or a sorted Column of a named column."""
    found = []
    for term in order:
        m = _ORDER.match(term if isinstance(term, str) else term._jc.toString())
        down = (m[2] or "ASC").upper() == "DESC"
        found.append((m[1], down, (m[3] or ("LAST" if down else "FIRST")).upper() == "FIRST"))
    return found


def _comparable(df: DataFrame, name: str) -> Column:
    """The column as something whose values a plan can hold as literals: times as microseconds."""
    kind = df.schema[name].dataType.typeName()
    return F.unix_micros(F.col(name).cast("timestamp")) if kind.startswith("timestamp") else F.col(name)


def _precedes(terms: list[tuple[Column, bool, bool]], values: tuple) -> Column:
    """Whether a row comes before the row with these order values."""
    found, equal = F.lit(False), F.lit(True)
    for (c, down, nulls_first), v in zip(terms, values):
        if v is None:
            before = F.lit(False) if nulls_first else c.isNotNull()
        else:
            before = F.coalesce(c > F.lit(v) if down else c < F.lit(v), F.lit(nulls_first))
        found, equal = found | (equal & before), equal & c.eqNullSafe(F.lit(v))
    return found


def _sorted(sample: list[tuple], directions: list[tuple[str, bool, bool]]) -> list[tuple]:
    """The sampled order values in their order (stable sorts from the last term to the first)."""
    def key(v):
        return (math.isnan(v), v) if isinstance(v, float) else bytes(v) if isinstance(v, bytearray) else v

    for i in reversed(range(len(directions))):
        _, down, nulls_first = directions[i]
        none = [r for r in sample if r[i] is None]
        some = sorted((r for r in sample if r[i] is not None), key=lambda r: key(r[i]), reverse=down)
        sample = none + some if nulls_first else some + none
    return sample


def page_slice(df: DataFrame, order: list[str | Column], offset: int, limit: int,
               per_page: int, page_col: str = "page") -> DataFrame:
    """Pages ``offset+1 .. offset+limit`` of ``per_page`` rows each in ``order`` (named columns, each
    ascending or descending; a unique order makes the slice deterministic).

    The slice is found by selection, not by sorting the table: a sample of the order values gives
    two bounds that the slice should lie between; one aggregate counts the rows before them and
    between them (bounds that missed the slice are widened); and the same is done again within
    what is between, until it is small. Only that is sorted. The sample decides how often the
    rows are counted, never which rows come out. Rows that many ties keep together, or a very large
    slice, are numbered over many partitions.
    """
    if offset < 0 or limit < 0 or per_page <= 0:
        raise ValueError("offset and limit must be >= 0 and per_page > 0")
    directions = _directions(order)
    terms = [(_comparable(df, name), down, first) for name, down, first in directions]
    sort = [getattr(c, f"{'desc' if down else 'asc'}_nulls_{'first' if first else 'last'}")() for c, down, first in terms]
    lo, hi = offset * per_page, (offset + limit) * per_page
    kept, base, rows = df, 0, None     # the candidates, the rows before them, and their number
    while lo < hi:
        seen = Observation()
        keys = kept.select(*[c.alias(f"_k{i}") for i, (c, _, _) in enumerate(terms)]).observe(seen, F.count(F.lit(1)).alias("n"))
        sample = _sorted([tuple(r) for r in keys.orderBy(F.rand(SEED)).limit(SAMPLE).collect()], directions)
        total = seen.get["n"]
        rows = total
        if not sample or lo - base >= total:
            return df.limit(0).withColumn(page_col, F.lit(0).cast("bigint"))
        first, last = lo - base, min(hi - base, total) - 1      # wanted, within the candidates
        slack = 0 if len(sample) == total else int(6 * math.sqrt(len(sample))) + 1
        narrower = None
        while narrower is None:
            a = int(first / total * len(sample)) - slack if slack else first
            b = int(math.ceil(last / total * len(sample))) + slack if slack else last
            if a <= 0 and b >= len(sample) - 1:
                break
            below = _precedes(terms, sample[a]) if a > 0 else F.lit(False)
            beyond = F.lit(False)
            if b < len(sample) - 1:
                beyond = ~_precedes(terms, sample[b])
                for i, ((c, _, _), v) in enumerate(zip(terms, sample[b])):   # rows equal to the bound stay
                    same = c.eqNullSafe(F.lit(v)) if i == 0 else same & c.eqNullSafe(F.lit(v))  # noqa: F821
                beyond = beyond & ~same
            if len(sample) == total:       # nothing is left to count
                before = sample.index(sample[a]) if a > 0 else 0
                between = (total if b >= total - 1 else total - sample[::-1].index(sample[b])) - before
            else:
                before, between = kept.agg(F.count_if(below), F.count_if(~below & ~beyond)).first()
            if before <= first and before + between > last:
                narrower = (kept.where(~below & ~beyond), base + before, between)
            slack = 2 * slack + 1
        if narrower is None or narrower[2] == total:
            break
        kept, base, rows = narrower
        if rows <= SORTED:
            break
    if rows is not None and rows <= SORTED:
        number = F.row_number().over(Window.orderBy(*sort)).cast("bigint") - 1
        placed = kept.withColumn("_ord", number)
    else:
        placed = with_ordinal(kept, [], sort, "_ord")
    place = F.col("_ord") + base
    return (placed.where((place >= lo) & (place < hi))
            .select(*df.columns, (F.floor(place / per_page) + 1).cast("bigint").alias(page_col)))
