"""Near-duplicate groups by MinHash with fast similarity sketching.

A document's set are its distinct word shingles. The sketch has ``t`` bins. In round i each
shingle falls into one bin by a hash of the round and keeps the smallest value there, values
of a later round being larger than all of an earlier one; rounds go on while a bin is empty,
and from round t on every shingle falls into bin i - t, so after 2t rounds no bin is empty.
Equal bins of two sketches estimate the Jaccard similarity with the concentration of t
independent hashes, at about one round's cost for a set much larger than t.

Bins are banded; documents that share a band are candidates, and candidates are linked only if
their full shingle sets reach the similarity. Documents with equal sets (by 128 bits of hashes)
count as one class from the start, so copies never meet pairwise. Links are sought in three rounds, each one only
where a band still holds several components: every class with the smallest class of a band
that it shares most bands with; the edges of a maximum spanning forest of each band by
sketch similarity; every remaining pair across components whose sketches are not far below
the similarity, once, in the first band that it shares. No other pair can change the components,
and none is left out for the size of its band.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import cut, fresh, hashed, key_filter, map_text, passes, ship, slices, text_buffer
from .words import U, distinct, mix, shingles, words

#: 32 bands of 4 bins: a pair of similarity 0.8 shares no band with probability 5e-8.
BANDS, ROWS = 32, 4
#: Bins of the sketch; the first BANDS * ROWS are banded.
BINS = 512
#: A pair is looked up unless its sketches agree in less than the similarity minus this much:
#: by 128 bins for the forest, by all for the rest (there 4.8 standard deviations at 0.8).
FOREST_MARGIN, MARGIN = 0.2, 0.085
#: Members of a band that meet as one block with another.
BLOCK = 2048


# ------------------------------------------------------------------ sketches
def sketch(values: np.ndarray, bounds: np.ndarray, bins: int) -> np.ndarray:
    """(documents, bins) sketch of each document's values (repeats do not matter); a document
    without values has the largest number everywhere."""
    empty = U(0xFFFFFFFFFFFFFFFF)
    out = np.full((len(bounds) - 1, bins), empty, U)
    open_docs = np.flatnonzero(np.diff(bounds))
    for i in range(2 * bins):
        if not len(open_docs):
            break
        n = np.diff(bounds)[open_docs]
        upto = np.cumsum(n)
        at = np.repeat(bounds[open_docs] - (upto - n), n) + np.arange(upto[-1])
        h = mix(values[at], 101 + i)
        rank = (U(i) << U(48)) | (h >> U(16))
        bin_ = (h & U(0xFFFF)).astype(np.int64) % bins if i < bins else np.int64(i - bins)
        np.minimum.at(out.reshape(-1), np.repeat(open_docs, n) * bins + bin_, rank)
        open_docs = open_docs[(out[open_docs] == empty).any(axis=1)]
    return out


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents, bands) hashes of the bands."""
    key = np.zeros((len(sketches), bands), U)
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = mix(key * U(0xD6E8FEB86659FD93) + sketches[:, r:bands * rows:rows], 7 + r)
        return mix(key + np.arange(bands, dtype=U), 3)


def set_digest(flat: np.ndarray, bounds: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """A digest of ``bits`` bits and a proof of 64 of each document's distinct values, in any
    order, from hashes of their own."""
    n = np.diff(bounds)
    some = np.flatnonzero(n)
    out = []
    for seed in (11, 51):
        total = np.zeros(len(n), U)
        with np.errstate(over="ignore"):
            if len(some):
                total[some] = np.add.reduceat(mix(flat, seed), bounds[some])
            out.append(mix(mix(total, seed + 10) + n.astype(U), seed + 11))
    return (out[0] >> U(64 - bits)).astype(np.int64), out[1].astype(np.int64)


def _sets(part: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, bounds, _ = words(*text_buffer(part.column("text")))
    return distinct(*shingles(hashes, bounds, width))


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as bytes."""
    width = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(width), len(rows),
                                 [None, pa.py_buffer(np.ascontiguousarray(rows))]).cast(pa.binary())


def _read_binary(column: pa.Array, dtype: str) -> np.ndarray:
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int32)[column.offset: column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[off[0]: off[-1]].view(dtype)
    return flat.reshape(len(column), -1)


def document_sets(docs: DataFrame, width: int, bands: int, rows: int, bits: int = 64) -> DataFrame:
    """``doc_id, n_shingles, digest, proof, sketch, bands`` of every row: ``digest`` and ``proof``
    stand for the set, ``sketch`` keeps 8 bits of each bin, ``bands`` holds the band hashes. A
    column ``row`` is passed through."""
    passed = [c for c in ("row",) if c in docs.columns]

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            flat, bounds = _sets(part, width)
            full = sketch(flat, bounds, max(BINS, bands * rows))
            digest, proof = set_digest(flat, bounds, bits)
            keys = band_keys(full, bands, rows).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands), pa.int32()),
                                             pa.array(keys.reshape(-1)))
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(bounds)), pa.array(digest), pa.array(proof),
                 _binary(mix(full, 5).astype(np.uint8)), lists, *[part.column(c) for c in passed]],
                ["doc_id", "n_shingles", "digest", "proof", "sketch", "bands", *passed])
        return one

    return map_text(docs, "text", make, "doc_id long, n_shingles long, digest long, proof long, "
                                        "sketch binary, bands array<long>" + "".join(f", {c} long" for c in passed))


# ------------------------------------------------------------------ verification
def class_ids(every: DataFrame) -> DataFrame:
    """Add ``class_id``: the digest, or another number for sets of one digest whose proofs differ
    (unequal sets), so that a class holds equal sets only, by 128 bits. Such digests are looked for
    in the narrow columns; where there is none, as nearly always, nothing is joined."""
    several = (every.groupBy("digest").agg(F.min("proof").alias("least"), F.max("proof").alias("largest"))
               .where("least <> largest").select("digest", "least"))
    if several.isEmpty():
        return every.withColumn("class_id", F.col("digest"))
    other = F.col("least").isNotNull() & (F.col("proof") != F.col("least"))
    return (every.join(several, "digest", "left")
            .withColumn("class_id", F.when(other, F.xxhash64("digest", "proof")).otherwise(F.col("digest"))).drop("least"))


def class_texts(docs: DataFrame, wanted: DataFrame, width: int, bits: int = 64) -> DataFrame:
    """``class_id, text``: the text of each wanted class's smallest id (of any of its rows
    where an id repeats). A bitmap of these ids keeps most other rows from the shuffle."""
    spark = docs.sparkSession
    bitmap = spark.sparkContext.broadcast(key_filter(wanted, "rep"))

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch | None:
            part = part.filter(pa.array(passes(bitmap.value, part.column("h").to_numpy())))
            if not part.num_rows:
                return None
            digest, proof = set_digest(*_sets(part, width), bits)
            return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(digest), pa.array(proof), part.column("text")],
                                              ["doc_id", "digest", "proof", "text"])
        return one

    some = map_text(docs.withColumn("h", hashed("doc_id")), "text", make, "doc_id long, digest long, proof long, text string")
    exact = wanted.select("class_id", "digest", "proof", F.col("rep").alias("doc_id"))
    return some.join(exact, ["digest", "proof", "doc_id"]).select("class_id", "text")


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose full sets have 100 * common >= percent * union."""
    a = texts.groupBy(F.col("class_id").alias("a")).agg(F.first("text").alias("text"))
    b = texts.groupBy(F.col("class_id").alias("b")).agg(F.first("text").alias("other"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "text", "other")

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch | None:
            left, lb = _sets(part, width)
            right, rb = _sets(pa.RecordBatch.from_arrays([part.column("other")], ["text"]), width)
            keep = []
            for i in range(part.num_rows):
                x, y = left[lb[i]:lb[i + 1]], right[rb[i]:rb[i + 1]]
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            return part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        return one

    return map_text(joined, "text", make, "a long, b long")


# ------------------------------------------------------------------ candidates
def star_pairs(members: DataFrame) -> DataFrame:
    """``(a, b)``: each class with the one smallest class of a band that it shares most bands
    with (the smallest such)."""
    centre = members.groupBy("band").agg(F.min("class_id").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = (members.join(centre, "band").where("class_id <> b")
              .groupBy(F.col("class_id").alias("a"), "b").agg(F.count(F.lit(1)).alias("bands")))
    best = shared.groupBy("a").agg(F.max(F.struct("bands", (-F.col("b")).alias("low"), "b")).alias("best"))
    return best.select("a", F.col("best.b").alias("b"))


def _dealt(members: DataFrame, extra: DataFrame, labels: DataFrame) -> DataFrame:
    """The classes of bands with several components, with their columns of ``extra``, dealt to
    tasks: block x of a band meets every block, as the lower or the upper of the two."""
    named = (members.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left")
             .select("band", "class_id", F.coalesce("label", "class_id").alias("label")))
    mixed = (named.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                       F.count(F.lit(1)).alias("size"))
             .where("lo <> hi").select("band", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    open_ = named.join(mixed, "band").withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    ship(members.sparkSession)
    return (open_.withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("band", F.least("block", "y").alias("lo"), F.greatest("block", "y").alias("hi"),
                    "block", "class_id", "label").join(extra, "class_id"))


def agreement(bins: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Estimated similarity of each row of 8-bit bins with one, chance agreement taken off."""
    same = (bins == one).view(np.uint8).sum(axis=1, dtype=np.uint16) / bins.shape[1]
    return (same - 1 / 256) / (1 - 1 / 256)


def _pairs(a: list[int], b: list[int]) -> pa.Table:
    return pa.table({"a": pa.array([max(x) for x in zip(a, b)], pa.int64()),
                     "b": pa.array([min(x) for x in zip(a, b)], pa.int64())})


def forest_pairs(members: DataFrame, classes: DataFrame, labels: DataFrame, floor: float) -> DataFrame:
    """``(a, b)``: a maximum spanning forest of each mixed band by sketch similarity, edges below
    ``floor`` left out; between two blocks of a large band each class's most similar one."""
    width = BANDS * ROWS
    extra = classes.select("class_id", F.expr(f"substring(sketch, 1, {width})").alias("sketch"))

    def edges(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        block, label = table["block"].to_numpy(), table["label"].to_numpy()
        order = np.argsort(table["class_id"].to_numpy(), kind="stable")
        ids, block, label = table["class_id"].to_numpy()[order], block[order], label[order]
        bins = _read_binary(table["sketch"].combine_chunks(), "u1")[order]
        a, b = [], []
        left, right = (np.flatnonzero(block == x) for x in (block.min(), block.max()))
        if block.min() != block.max():
            for i in left:
                near = agreement(bins[right], bins[i])
                near[label[right] == label[i]] = -1
                j = int(near.argmax())
                if near[j] >= floor:
                    a.append(int(ids[i]))
                    b.append(int(ids[right[j]]))
            return _pairs(a, b)
        # Prim's algorithm; classes of one component are joined at no cost.
        n = len(ids)
        best, who = np.full(n, -1.0), np.zeros(n, np.int64)
        todo = np.ones(n, bool)
        i = 0
        for _ in range(n):
            todo[i] = False
            near = np.where(label == label[i], 2.0, agreement(bins, bins[i]))
            up = near > best
            best[up], who[up] = near[up], i
            if not todo.any():
                break
            i = int(np.where(todo, best, -2.0).argmax())
            if floor <= best[i] < 2:
                a.append(int(ids[i]))
                b.append(int(ids[who[i]]))
        return _pairs(a, b)

    return (_dealt(members, extra, labels).groupBy("band", "lo", "hi").applyInArrow(edges, "a long, b long")
            .where("a <> b").distinct())


def rest_links(members: DataFrame, classes: DataFrame, labels: DataFrame, texts_of, width: int,
               percent: int) -> DataFrame:
    """``(a, b)``: links between components among all pairs across components that share a band
    and whose sketches are not far below the similarity, each pair tested once, in the first
    band that it shares; of links that would join the same components one is enough.

    Two steps, neither of which makes a row per pair: each block lists the classes that have
    such pairs, and each class's partners as an array; then the full sets of these classes
    meet in the block and are compared there."""
    floor = percent / 100 - MARGIN
    key = ["band", "lo", "hi"]

    def near(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        block, label = table["block"].to_numpy(), table["label"].to_numpy()
        ids, band = table["class_id"].to_numpy(), table["band"][0].as_py()
        bins = _read_binary(table["sketch"].combine_chunks(), "u1")
        bands = _lists(table["bands"].combine_chunks())
        mine = (bands == band).argmax(axis=1)
        left, right = (np.flatnonzero(block == x) for x in (block.min(), block.max()))
        met, rows = set(), []
        for i in left:
            some = right[label[right] != label[i]]
            some = some[some > i] if block.min() == block.max() else some
            like = agreement(bins[some], bins[i])
            some = some[like >= floor][np.argsort(-like[like >= floor], kind="stable")]
            some = some[(bands[some] == bands[i]).argmax(axis=1) == mine[i]]
            if len(some):
                met.update([i, *some.tolist()])
                rows.append((int(i), some))
        met = np.array(sorted(met), np.int64)
        n, m = len(rows), len(met)
        at = np.array([r[0] for r in rows], np.int64)
        lists = [np.concatenate([[0], np.cumsum([len(r[1]) for r in rows])]).astype(np.int32)]
        flat = np.concatenate([r[1] for r in rows]) if rows else met
        none = pa.nulls(m, pa.list_(pa.int64()))
        return pa.table({
            **{k: pa.array([table[k][0].as_py()] * (n + m), table[k].type) for k in key},
            "class_id": pa.array(np.concatenate([ids[at], ids[met]]), pa.int64()),
            "label": pa.array(np.concatenate([label[at], label[met]]), pa.int64()),
            "others": pa.concat_arrays([pa.ListArray.from_arrays(pa.array(lists[0]), pa.array(ids[flat], pa.int64()))
                                        if rows else pa.nulls(0, pa.list_(pa.int64())), none])})

    def confirm(_, pairs: pa.Table, texts: pa.Table) -> pa.Table:
        sets = {}
        for batch in texts.combine_chunks().to_batches():
            for part in slices(batch, "text"):
                flat, bounds = _sets(part, width)
                for k, c in enumerate(part.column("class_id").to_pylist()):
                    sets[c] = flat[bounds[k]:bounds[k + 1]]
        label = dict(zip(texts["class_id"].to_pylist(), texts["label"].to_pylist()))

        def find(x: int) -> int:
            while up.setdefault(x, x) != x:
                x = up[x]
            return x

        up: dict[int, int] = {}
        a, b = [], []
        for one, others in zip(pairs["class_id"].to_pylist(), pairs["others"].to_pylist()):
            for other in others:
                p, q = find(label[one]), find(label[other])
                if p == q:
                    continue
                x, y = sets[one], sets[other]
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    up[p] = q
                    a.append(one)
                    b.append(other)
        return _pairs(a, b)

    schema = "band long, lo int, hi int, class_id long, label long, others array<long>"
    found = cut(_dealt(members, classes.select("class_id", "sketch", "bands"), labels)
                .groupBy(*key).applyInArrow(near, schema))
    met = found.where("others IS NULL").drop("others")
    if met.isEmpty():
        return met.select(F.col("class_id").alias("a"), F.col("class_id").alias("b")).limit(0)
    texts = texts_of(met.select("class_id").distinct())
    texts = texts.groupBy("class_id").agg(F.first("text").alias("text"))
    pairs = found.where("others IS NOT NULL").select(*key, "class_id", "others").toDF(*key, "class_id", "others")
    sets = met.join(texts, "class_id").select(*key, "class_id", "label", "text").toDF(*key, "class_id", "label", "text")
    return pairs.groupBy(*key).cogroup(sets.groupBy(*key)).applyInArrow(confirm, "a long, b long")


def _lists(column: pa.Array) -> np.ndarray:
    """A matrix from lists of equal length."""
    off = column.offsets.to_numpy()
    return column.values.to_numpy()[off[0]:off[-1]].reshape(len(column), -1)


# ------------------------------------------------------------------ the operator
def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
           percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id that
    links reach) and ``kept`` (whether that is its own).

    A set holds the distinct ``width``-word shingles; a text with fewer words has them all as
    its one shingle. A text without words (null, empty or white space) has an empty set and is
    linked with nothing. A row with a null id takes no part in linking: its component is null
    and it is kept. A repeated id is judged row by row. Other columns are ignored; an empty
    table gives no rows; texts of any length are read whole.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return (judged(narrow, width, percent, bands, rows)
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("smallest"))
                           .otherwise(F.col("doc_id"))).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))))


def judged(narrow: DataFrame, width: int, percent: int, bands: int, rows: int, bits: int = 64) -> DataFrame:
    """``doc_id, n_shingles, class_id, label, smallest`` (and ``row``) of every row of ``doc_id,
    text``: ``label`` names the component, ``smallest`` is the smallest id in it. Two components
    may have the same smallest id where an id repeats."""
    every = class_ids(cut(document_sets(narrow, width, bands, rows, bits)))
    usable = every.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Classes of equal sets; a class's sketch and bands are those of any of its documents.
    classes = cut(usable.groupBy("class_id").agg(F.min("doc_id").alias("rep"), F.first("digest").alias("digest"),
                                                 F.first("proof").alias("proof"), F.first("sketch").alias("sketch"),
                                                 F.first("bands").alias("bands")))
    many = classes.select("class_id", F.explode("bands").alias("band"))
    # Only bands of several classes.
    members = cut(many.join(many.groupBy("band").count().where("count > 1"), "band", "left_semi"))
    real = narrow.where("doc_id IS NOT NULL").select("doc_id", "text")

    def texts_of(some: DataFrame) -> DataFrame:
        return class_texts(real, classes.join(some, "class_id", "left_semi"), width, bits)

    def links(pairs: DataFrame) -> DataFrame:
        if pairs.isEmpty():
            return pairs
        ends = pairs.select(F.explode(F.array("a", "b")).alias("class_id")).distinct()
        return cut(verified(pairs, texts_of(ends), width, percent))

    pairs = cut(star_pairs(members))
    found = links(pairs)
    labels = components(found)
    more = cut(forest_pairs(members, classes, labels, percent / 100 - FOREST_MARGIN).join(pairs, ["a", "b"], "left_anti"))
    found = found.unionByName(links(more))
    labels = components(found)
    labels = components(found.unionByName(rest_links(members, classes, labels, texts_of, width, percent)))
    named = (classes.select("class_id", "rep")
             .join(labels.withColumnRenamed("node", "class_id"), "class_id", "left")
             .withColumn("label", F.coalesce("label", "class_id")))
    smallest = named.groupBy("label").agg(F.min("rep").alias("smallest"))
    answer = named.join(smallest, "label").select("class_id", "label", "smallest")
    return every.drop("sketch", "bands", "digest", "proof").join(answer, "class_id", "left")


def one_per_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                  percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``docs`` with one row of each group: the row of its smallest id, the smallest such row by
    a hash of its columns where an id repeats. Rows without an id and rows without words are in
    no group and all stay. Columns may have any name; an empty table gives no rows."""
    # a map has no hash of its own: its JSON stands for it
    hashable = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema.fields]
    id_, row = fresh(docs, "_key_id", "_key_row")
    keyed = docs.withColumns({id_: F.col(id_col).cast("long"), row: F.xxhash64(*hashable)})
    text = F.col(text_col).cast("string")
    grouped = F.col(id_).isNotNull() & F.coalesce(text, F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    narrow = keyed.where(grouped).select(F.col(id_).alias("doc_id"), text.alias("text"), F.col(row).alias("row"))
    keep = (judged(narrow, width, percent, bands, rows).where("doc_id = smallest")
            .groupBy("label", F.col("doc_id").alias(id_)).agg(F.min("row").alias(row)).select(id_, row))
    # Equal rows meet before the join, already within a task, so a frequent id is no large group.
    one = keyed.where(grouped).dropDuplicates([id_, row]).join(keep, [id_, row], "left_semi")
    return one.unionByName(keyed.where(~grouped)).select(*docs.columns)
