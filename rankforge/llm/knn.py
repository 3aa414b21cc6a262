"""Exact top-k search by inner product as a Voronoi kNN join.

With every candidate x extended by sqrt(M^2 - |x|^2), where M is the largest norm, and every
query q by 0, |q - x|^2 = |q|^2 + M^2 - 2 q.x, so the largest products are the nearest points.
Pivots (k-means of a bounded sample) cut the space into cells:

1. Queries go to the cell of their nearest pivot. A cell's queries form a group with radius
   U = the largest distance of a member to the pivot.
2. Summaries of all candidates: for each pivot the k + 1 smallest distances and a histogram of
   the distances. A member's k-th neighbour is no further than theta = U + the (k+1)-th
   smallest distance (the member itself may be among them).
3. By the triangle inequality a candidate further than theta + U from the pivot is no
   neighbour of any member; it is replicated only to the groups it is not ruled out for. Of
   equal vectors only the k + 1 smallest ids of a batch are sent.
4. A group's candidates are dealt to blocks of bounded size (their number follows from the
   histogram), its queries to all of them; each block is solved by a matrix product in slices,
   and the blocks' winners are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import cut, ship

K = 5
SCALE = 256.0
QUERY_EVERY = 50
#: Vectors the pivots are fitted on, at most; rounds of k-means; histogram bins.
SAMPLE, ROUNDS, BINS = 4096, 8, 256
MAX_PIVOTS = 256
#: Candidates and queries of one block, about; queries multiplied at a time.
BLOCK, QUERIES, SLICE = 16384, 4096, 256


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors stored as little-endian 64-bit integers; shorter ones are filled with zeros."""
    out = np.zeros((len(column), dims), np.int64)
    for i, raw in enumerate(column):
        v = np.frombuffer(raw.as_buffer(), "<i8")
        out[i, :len(v)] = v
    return out


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """``vec_id, v, norm``: floor(scale * x) of each component as bytes, and the squared norm.
    Rows without an id, without a vector, or with a null, infinite or undefined component
    are left out; equal rows count once."""
    ship(vectors.sparkSession)

    def run(batches):
        for batch in batches:
            ids, raws, norms = [], [], []
            for i, x in zip(batch.column("vec_id").to_pylist(), batch.column("x")):
                if i is None or not x.is_valid or x.values.null_count:
                    continue
                v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(v).all():
                    continue
                v = np.floor(scale * v).astype("<i8")
                ids.append(i)
                raws.append(v.tobytes())
                norms.append(float((v.astype(np.float64) ** 2).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(raws, pa.binary()),
                                              pa.array(norms, pa.float64())], ["vec_id", "v", "norm"])

    narrow = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("x"))
    return narrow.mapInArrow(run, "vec_id long, v binary, norm double").distinct()


def _distances(points: np.ndarray, norms: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of extended points to extended pivots."""
    x = points.astype(np.float64)
    square = norms[:, None] + (pivots ** 2).sum(axis=1)[None, :] - 2 * (x @ pivots[:, :-1].T)
    square += (extra ** 2)[:, None] - 2 * extra[:, None] * pivots[None, :, -1]
    return np.sqrt(np.maximum(square, 0))


def fit_pivots(points: np.ndarray, count: int, rounds: int = ROUNDS) -> np.ndarray:
    """k-means centres of the sample, started from points far from each other."""
    pick = [0]
    far = ((points - points[0]) ** 2).sum(axis=1)
    while len(pick) < min(count, len(points)):
        pick.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[pick[-1]]) ** 2).sum(axis=1))
    centres = points[pick].copy()
    for _ in range(rounds):
        near = ((points ** 2).sum(1)[:, None] - 2 * points @ centres.T + (centres ** 2).sum(1)).argmin(axis=1)
        for c in np.unique(near):
            centres[c] = points[near == c].mean(axis=0)
    return centres


def best(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int):
    """(query row, id, product) of each query's k largest products with other ids; ties go to
    the smaller id. Exact: in double precision while products stay below 2^53."""
    order = np.argsort(ids, kind="stable")
    data, ids = data[order], ids[order]
    top = max((int(np.abs(m).max()) for m in (queries, data) if m.size), default=0)
    kind = np.float64 if top * top * max(1, data.shape[1]) < 1 << 53 else np.int64
    data_t = data.astype(kind).T
    rows, found, scores = [], [], []
    for a in range(0, len(queries), SLICE):
        product = queries[a:a + SLICE].astype(kind) @ data_t
        for i, line in enumerate(product):
            n = min(len(line), k + 1)
            least = np.partition(line, len(line) - n)[len(line) - n] if len(line) > n else line.min()
            at = np.flatnonzero(line >= least)
            at = at[ids[at] != query_ids[a + i]]
            at = at[np.argsort(-line[at], kind="stable")][:k]
            rows.append(np.full(len(at), a + i))
            found.append(ids[at])
            scores.append(line[at].astype(np.int64))
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores)


def top_k(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
          scale: float = SCALE, query_every: int = QUERY_EVERY, pivots: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose id is divisible by
    ``query_every`` the ``k`` rows of another id with the largest integer products, ties to the
    smaller id; fewer if there are fewer.

    Rows without an id or with a vector that is null or has a null or non-finite component
    take no part; equal rows count once; of different vectors under one id each is a
    candidate, and each is a query when the id is (their results are ranked together);
    vectors of fewer components are filled with zeros; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    data = cut(integer_vectors(vectors, id_col, vec_col, scale))
    asked = (F.col("vec_id") % query_every == 0)
    head = data.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("norm"), F.max(F.length("v")).alias("bytes"),
                    F.count_if(asked).alias("queries")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not head["queries"]:
        return spark.createDataFrame([], schema)
    dims, largest = head["bytes"] // 8, head["norm"]
    count = pivots or max(2, min(MAX_PIVOTS, round(head["queries"] ** 0.5 / 4)))
    part = min(1.0, SAMPLE / head["n"])
    some = data.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)) < int(part * (1 << 30)) + 1)
    sample = some.limit(2 * SAMPLE).toArrow().combine_chunks()
    if not sample.num_rows:
        sample = data.limit(SAMPLE).toArrow().combine_chunks()
    points = _matrix(sample["v"].combine_chunks(), dims).astype(np.float64)
    last = np.sqrt(np.maximum(largest - (points ** 2).sum(axis=1), 0))
    centres = spark.sparkContext.broadcast(fit_pivots(np.column_stack([points, last]), count))
    count = len(centres.value)
    reach = 4 * (largest ** 0.5 + 1)

    # 1. query groups
    def assign(batches):
        for b in batches:
            x, norms = _matrix(b.column("v"), dims), b.column("norm").to_numpy()
            d = _distances(x, norms, np.zeros(len(x)), centres.value)
            near = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("v"), pa.array(near), pa.array(d[np.arange(len(x)), near])],
                ["vec_id", "v", "cell", "d"])

    queries = cut(data.where(asked).mapInArrow(assign, "vec_id long, v binary, cell long, d double"))
    radius = {r["cell"]: (r["u"], r["n"]) for r in
              queries.groupBy("cell").agg(F.max("d").alias("u"), F.count(F.lit(1)).alias("n")).collect()}

    # 2. summaries of the candidates
    def summarise(batches):
        for b in batches:
            x, norms = _matrix(b.column("v"), dims), b.column("norm").to_numpy()
            d = _distances(x, norms, np.sqrt(np.maximum(largest - norms, 0)), centres.value)
            near = np.sort(d, axis=0)[:k + 1]
            bins = np.minimum((d / reach * BINS).astype(np.int64), BINS - 1)
            hist = np.stack([np.bincount(bins[:, c], minlength=BINS) for c in range(count)])
            c, v = np.nonzero(hist)
            cells = np.tile(np.arange(count), len(near))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([cells, c])), pa.array(np.concatenate([near.reshape(-1), np.full(len(c), -1.0)])),
                 pa.array(np.concatenate([np.full(len(cells), -1), v])),
                 pa.array(np.concatenate([np.zeros(len(cells), np.int64), hist[c, v]]))],
                ["cell", "d", "bin", "n"])

    summary = cut(data.mapInArrow(summarise, "cell long, d double, bin long, n long"))
    first = Window.partitionBy("cell").orderBy("d")
    nearest = (summary.where("bin < 0").withColumn("r", F.row_number().over(first)).where(f"r <= {k + 1}")
               .groupBy("cell").agg(F.max("d").alias("d"), F.count(F.lit(1)).alias("n")).collect())
    counts = np.zeros((count, BINS), np.int64)
    for r in summary.where("bin >= 0").groupBy("cell", "bin").agg(F.sum("n").alias("n")).collect():
        counts[r["cell"], r["bin"]] = r["n"]
    limit = np.full(count, -1.0)
    for r in nearest:
        if r["cell"] in radius:
            u = radius[r["cell"]][0]
            # fewer than k + 1 candidates rule nothing out; the slack covers rounding
            limit[r["cell"]] = (2 * u + r["d"]) * (1 + 1e-9) + 1e-3 if r["n"] > k else np.inf
    blocks = np.ones(count, np.int64)
    parts = np.ones(count, np.int64)
    for c in range(count):
        upto = BINS if np.isinf(limit[c]) else min(int(max(limit[c], 0) / reach * BINS) + 1, BINS)
        blocks[c] = max(1, -(-int(counts[c, :upto].sum()) // BLOCK))
        parts[c] = max(1, -(-radius.get(c, (0, 0))[1] // QUERIES))

    # 3. replicate what no bound rules out, to blocks of candidates times parts of queries
    def replicate(batches):
        for b in batches:
            x, norms = _matrix(b.column("v"), dims), b.column("norm").to_numpy()
            ids = b.column("vec_id").to_numpy()
            d = _distances(x, norms, np.sqrt(np.maximum(largest - norms, 0)), centres.value)
            order = np.lexsort((ids, *x.T[::-1]))
            fresh = np.append(True, (np.diff(x[order], axis=0) != 0).any(axis=1)) if len(x) else np.zeros(0, bool)
            place = np.arange(len(x)) - np.maximum.accumulate(np.where(fresh, np.arange(len(x)), 0))
            keep = np.zeros(len(x), bool)
            keep[order] = place <= k
            for c in np.flatnonzero(limit >= 0):
                rows = np.flatnonzero(keep & (d[:, c] <= limit[c]))
                block = (ids[rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(blocks[c])
                for p in range(parts[c]):
                    at = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), c)), pa.array(block.astype(np.int64)),
                         pa.array(np.full(len(rows), p)), b.column("vec_id").take(at), b.column("v").take(at),
                         pa.array(np.zeros(len(rows), bool))], ["cell", "block", "part", "vec_id", "v", "query"])

    schema_all = "cell long, block long, part long, vec_id long, v binary, query boolean"
    sent = data.mapInArrow(replicate, schema_all)
    of = lambda values: F.element_at(F.array(*[F.lit(int(x)) for x in values]), (F.col("cell") + 1).cast("int"))
    asking = queries.select(
        "cell", F.explode(F.sequence(F.lit(0), of(blocks) - 1).cast("array<long>")).alias("block"),
        F.pmod(F.xxhash64("vec_id", "v"), of(parts)).cast("long").alias("part"), "vec_id", "v", F.lit(True).alias("query"))

    # 4. solve block by block
    def solve(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        is_query = table["query"].to_numpy(zero_copy_only=False)
        ids = table["vec_id"].to_numpy()
        x = _matrix(table["v"].combine_chunks(), dims)
        q, c = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        if not len(q) or not len(c):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.int64())})
        row, found, score = best(x[q], ids[q], x[c], ids[c], k)
        return pa.table({"query_id": ids[q][row], "vec_id": found, "score": score})

    won = sent.unionByName(asking).groupBy("cell", "block", "part").applyInArrow(
        solve, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (won.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
