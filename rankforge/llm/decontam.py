"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item's set are its distinct word shingles, and a document holds it if the document has
at least the threshold share of them. Jaccard similarity is of no use for a short item in a
long document, so the sketch is made for containment: items are partitioned by the size of
their sets, and an item of n shingles, of which at least m = ceil(threshold * n) must be
present, keeps its n - m + 1 smallest hash values (bottom-k MinHash). A document that holds the
item misses at most n - m of its shingles, so it has one of the kept values: the search loses
nothing. A document's own hash values count for a partition only up to the largest value
kept there, and only for partitions whose smallest item its size can hold. Candidates are
verified by the exact number of the item's shingles in the whole document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import FILTER_BITS, cut, fresh, hashed, key_filter, map_text, passes, text_buffer
from .words import U, distinct, document_of, shingles, words

WIDTH = 5
PERCENT = 80


def _keyed(df: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """``name``, ``key`` and ``text``: rows equal in id and text share a key."""
    return (df.select(F.col(id_col).cast("long").alias(name), F.col(text_col).cast("string").alias("text"))
            .withColumn("key", F.xxhash64(name, "text")))


def item_sets(items: DataFrame, width: int, percent: int) -> DataFrame:
    """``item_id, item_key, n, part, h, rank``: each distinct shingle of each item with its rank
    by hash; ``part`` is the partition (the bits of n). Equal rows count once."""

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            hashes, bounds, _ = words(*text_buffer(part.column("text")))
            flat, bounds = distinct(*shingles(hashes, bounds, width))
            row = document_of(bounds)
            n = np.diff(bounds)[row]
            return pa.RecordBatch.from_arrays(
                [part.column("item_id").take(pa.array(row)), part.column("key").take(pa.array(row)), pa.array(n),
                 pa.array(flat.view(np.int64)), pa.array(np.arange(len(row)) - bounds[row])],
                ["item_id", "item_key", "n", "h", "rank"])
        return one

    found = map_text(_keyed(items, "item_id", "text", "item_id").dropDuplicates(["item_id", "key"]), "text", make,
                     "item_id long, item_key long, n long, h long, rank long")
    return (found.withColumn("part", F.length(F.bin("n")))
            .withColumn("least", F.ceil(F.col("n") * percent / 100).cast("long")))


def _document_hits(docs: DataFrame, bitmap: np.ndarray, width: int,
                   bounds_of: np.ndarray | None, only: np.ndarray | None) -> DataFrame:
    """``doc_id, key, n_doc, h``: the distinct shingles of the documents that may be in the
    bitmap. ``bounds_of``: rows (smallest size, largest value), one for each partition, of which
    a document must meet one; ``only``: a bitmap of the documents that count."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((bitmap, bounds_of, only))

    def make():
        filter_, limits, keys = shared.value

        def one(part: pa.RecordBatch) -> pa.RecordBatch | None:
            if keys is not None:
                part = part.filter(pa.array(passes(keys, part.column("kh").to_numpy())))
            if not part.num_rows:
                return None
            hashes, bounds, _ = words(*text_buffer(part.column("text")))
            flat, bounds = shingles(hashes, bounds, width)
            hit = np.flatnonzero(passes(filter_, (flat >> U(64 - FILTER_BITS)).astype(np.int64)))
            row = document_of(bounds)[hit]
            if not len(hit):
                return None
            some = np.unique(row)
            size = np.zeros(part.num_rows, np.int64)
            size[some] = [len(np.unique(flat[bounds[d]:bounds[d + 1]])) for d in some]
            value = flat[hit]
            if limits is not None:
                fits = np.zeros(len(hit), bool)
                for least, largest in limits:
                    fits |= (size[row] >= int(least)) & (value <= largest)
                row, value = row[fits], value[fits]
            pair = np.unique(np.stack([row.astype(U), value], axis=1), axis=0) if len(row) else None
            if pair is None:
                return None
            row, value = pair[:, 0].astype(np.int64), pair[:, 1]
            at = pa.array(row)
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(at), part.column("key").take(at), pa.array(size[row]),
                 pa.array(value.view(np.int64))], ["doc_id", "key", "n_doc", "h"])
        return one

    return map_text(docs.withColumn("kh", hashed("key")), "text", make, "doc_id long, key long, n_doc long, h long")


def _hash_filter(sets: DataFrame) -> np.ndarray:
    """A bitmap over the leading bits of the shingle hashes."""
    return key_filter(sets, "h", F.shiftrightunsigned("h", 64 - FILTER_BITS).cast("int"))


def leaks(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", width: int = WIDTH,
          percent: int = PERCENT) -> DataFrame:
    """One row per document and item that it holds: ``doc_id, item_id, item_shingles,
    common`` (distinct item shingles in the document) and ``containment``, with ``key``, a
    hash of id and text that tells rows of one id apart.

    100 * common >= percent * item_shingles. An item or text with fewer than ``width`` words is
    one shingle; without words (null, empty) it holds nothing and is held by nothing. Rows
    equal in id and text give one row; null ids are kept as null; other columns are ignored;
    empty tables give no rows; texts are read whole.
    """
    named = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text"))
    sets = cut(item_sets(named, width, percent))
    sketch = sets.where("rank <= n - least")
    parts = sketch.groupBy("part").agg(F.min("least").alias("least"),
                                       F.max(F.expr("h ^ -9223372036854775808")).alias("top")).collect()
    if not parts:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, key long, item_id long, item_shingles long, common long, containment double")
    # At most 64 partitions; the values are ordered as unsigned numbers.
    limits = np.array([[r["least"], (r["top"] + (1 << 63))] for r in parts], dtype=U)
    rows = _keyed(docs, id_col, text_col, "doc_id")
    seen = _document_hits(rows, _hash_filter(sketch), width, limits, None)
    candidates = cut(seen.join(sketch.select("h", "item_key", "least"), "h").where("n_doc >= least")
                     .select("doc_id", "key", "item_key").distinct())
    wanted = sets.join(candidates.select("item_key").distinct(), "item_key", "left_semi")
    full = _document_hits(rows, _hash_filter(wanted), width, None, key_filter(candidates, "key"))
    pair = candidates.select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), F.col("item_key").alias("_item"))
    counted = (full.select("doc_id", "key", "h").distinct()
               .join(wanted.select("h", "item_id", "item_key", "n", "least"), "h")
               .groupBy("doc_id", "key", "item_id", "item_key", "n", "least")
               .agg(F.count(F.lit(1)).alias("common")).where("common >= least"))
    same = (F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("key") == F.col("_key"))
            & (F.col("item_key") == F.col("_item")))
    return (counted.join(pair, same, "left_semi")
            .groupBy("doc_id", "key", "item_id")
            .agg(F.max(F.struct((F.col("common") / F.col("n")).alias("containment"), F.col("n").alias("item_shingles"),
                                "common")).alias("best"))
            .select("doc_id", "key", "item_id", "best.item_shingles", "best.common", "best.containment"))


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns, whatever their names.

    A row goes if its own id and text are those of a leak, so rows that share an id are judged one by
    one and equal rows go or stay together. Null ids are ids like any other; a null or empty text
    holds nothing and stays; an empty table of documents gives no rows, one of items keeps all.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    doc, hash_ = fresh(docs, "_doc", "_key")
    found = leaks(docs, items, **options).select(F.col("doc_id").alias(doc), F.col("key").alias(hash_)).distinct()
    key = F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(doc)) & (key == F.col(hash_))
    return docs.join(found, same, "left_anti")
