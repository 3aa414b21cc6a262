"""Centroid clustering with bounds that follow the centroids' movement (geometric drift tightening).

Every vector keeps an upper bound on the distance to its centroid and one lower bound on the
distance to any other. After a round the centroids move; the usual way to keep the lower bound
valid is to take off the longest way that any centroid went. Here each cluster is a sphere
(its old centroid, its largest upper bound) and each moved centroid is bounded against that
sphere:

The function d(x, old) - d(x, new) depends on two coordinates of x only: along the line from
old to new, and away from it; so the sphere can be looked at in the plane through its centre
and that line. Its level sets there are hyperbola branches around ``new`` with foci ``old`` and
``new``, each within the cone of its asymptotes, whose apex is the midpoint: where the angle
between the line and x, seen from the midpoint, is at least t, the difference is at most
|new - old| cos t. A sphere of radius r whose centre is at distance R and angle p has no point
at a smaller angle than t = p - arcsin(r / R). Where t passes a right angle the centroid moves
away from the whole sphere and the lower bound even grows.

A vector whose upper bound stays below its lower one keeps its cluster unseen; all others are
scanned exactly in integers. Sums of a round come from the vectors that changed cluster only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .frames import ship

DIMS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 64.0, 16, 3, "1"
#: Integer components must stay below this, so that every squared distance is a 64-bit integer.
PEAK = 1 << 26
#: Up to this component, products and sums of 64 of them are exact in double precision.
EXACT = 1 << 22
#: Relative widening of the bounds, far above the rounding of a few double operations.
SLACK = 1e-9

_STATE = "vec_id long, v binary, cluster int, was int, upper double, lower double, scanned boolean"
_FINAL = "vec_id long, cluster int, distance long"


@dataclass
class Fit:
    """Final centroids, rows per cluster, inertia per cluster, and for every assignment how many
    vectors it scanned and how many changed cluster."""

    centroids: np.ndarray
    rows: int = 0
    inertia: dict[int, int] = field(default_factory=dict)
    scanned: list[int] = field(default_factory=list)
    changed: list[int] = field(default_factory=list)


# ------------------------------------------------------------------ vectors
def _kept(column: pa.Array, dims: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, integer vectors) of the rows with ``dims`` finite components."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    right = pc.fill_null(pc.equal(pc.list_value_length(column), dims), False)
    at = np.flatnonzero(right.to_numpy(zero_copy_only=False))
    x = column.filter(right).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    finite = np.isfinite(x).all(axis=1)
    with np.errstate(over="ignore"):
        v = np.floor(scale * x[finite])
    if v.size and np.abs(v).max() >= PEAK:
        raise ValueError(f"a vector has a component of {PEAK / scale:g} or more: squared distances would not fit 64 bits")
    return at[finite], v.astype(np.int64)


def _pack(v: np.ndarray) -> pa.Array:
    """Vectors as little-endian bytes, in the narrowest width that the batch allows."""
    top = int(np.abs(v).max()) if v.size else 0
    kind = "<i1" if top < 128 else "<i2" if top < 1 << 15 else "<i4"
    raw = np.ascontiguousarray(v.astype(kind)).tobytes()
    width = v.shape[1] * int(kind[-1])
    offsets = np.arange(len(v) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(v), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw)]).cast(pa.binary())


def _unpack(column: pa.Array, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims), np.int64)
    width = pc.binary_length(column).to_numpy(zero_copy_only=False) // dims
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        raw = b"".join(column.take(pa.array(at)).to_pylist())
        out[at] = np.frombuffer(raw, f"<i{w}").reshape(-1, dims)
    return out


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: float) -> DataFrame:
    """``vec_id, v``: floor(scale * x) of each component, of the rows with ``dims`` finite ones."""
    ship(vectors.sparkSession)

    def run(batches):
        for batch in batches:
            at, v = _kept(batch.column("x"), dims, scale)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(at)), _pack(v)], ["vec_id", "v"])

    narrow = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
    return narrow.mapInArrow(run, "vec_id long, v binary")


def squared_distances(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, one row per vector and one column per centroid."""
    top = max((int(np.abs(m).max()) for m in (v, centroids) if m.size), default=0)
    if top < EXACT and v.shape[1] <= DIMS:
        x, c = v.astype(np.float64), centroids.astype(np.float64)
        found = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
        return found.astype(np.int64)
    return np.stack([((v - c) ** 2).sum(axis=1) for c in centroids], axis=1)


# ------------------------------------------------------------------ bounds
def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """``out[i, j]``: no vector within ``radius[i]`` of ``old[i]`` comes closer to centroid j by
    more than this when it moves from ``old[j]`` to ``new[j]`` (below 0: every one gets farther)."""
    k = len(old)
    out = np.zeros((k, k))
    for j in range(k):
        way = (new[j] - old[j]).astype(np.float64)
        drift = math.sqrt(float(way @ way))
        if drift == 0:
            continue
        middle = (old[j] + new[j]) / 2
        for i in range(k):
            w = old[i] - middle
            r, far, along = float(radius[i]), math.sqrt(float(w @ w)), float(w @ way) / drift
            bound = drift
            if far > r:
                angle = math.acos(max(-1.0, min(1.0, along / far))) - math.asin(r / far)
                if angle >= math.pi / 2:
                    bound = drift * min(0.0, along + r) / math.hypot(far + r, drift / 2)
                elif angle > 0:
                    bound = drift * math.cos(angle)
            out[i, j] = bound + SLACK * (drift + far + r)
    return out


def drifts(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How far each centroid moved, from above."""
    return np.sqrt(((new - old).astype(np.float64) ** 2).sum(axis=1)) * (1 + SLACK)


def _scan(v: np.ndarray, centroids: np.ndarray):
    """(cluster, upper, lower) by an exact scan; ties go to the smaller number."""
    d = squared_distances(v, centroids)
    cluster = d.argmin(axis=1)
    upper = np.sqrt(d[np.arange(len(d)), cluster].astype(np.float64)) * (1 + SLACK)
    lower = np.full(len(d), np.inf)
    if d.shape[1] > 1:
        lower = np.sqrt(np.partition(d, 1, axis=1)[:, 1].astype(np.float64)) * (1 - SLACK)
    return cluster, upper, lower


def _own(v: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    return ((v - centroids[cluster]) ** 2).sum(axis=1)


def reassign(v: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray,
             moved: np.ndarray, looser: np.ndarray):
    """(cluster, upper, lower, scanned) after the centroids moved: ``moved`` is each one's drift,
    ``looser`` what each cluster's lower bounds lose."""
    cluster, upper, lower = cluster.copy(), upper + moved[cluster], lower - looser[cluster]
    scanned = np.zeros(len(v), bool)
    at = np.flatnonzero(~(upper < lower))
    if len(at):   # the exact distance to the own centroid first
        upper[at] = np.sqrt(_own(v[at], centroids, cluster[at]).astype(np.float64)) * (1 + SLACK)
        at = at[~(upper[at] < lower[at])]
    if len(at):
        scanned[at] = True
        cluster[at], upper[at], lower[at] = _scan(v[at], centroids)
    return cluster, upper, lower, scanned


# ------------------------------------------------------------------ passes over the vectors
def _batch(arrays: list, schema: str) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays(arrays, names)


def _first_pass(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    dims = centroids.shape[1]

    def run(batches):
        for batch in batches:
            v = _unpack(batch.column("v"), dims)
            cluster, upper, lower = _scan(v, centroids)
            yield _batch([batch.column("vec_id"), batch.column("v"), pa.array(cluster.astype(np.int32)),
                          pa.array(np.full(len(v), -1, np.int32)), pa.array(upper), pa.array(lower),
                          pa.array(np.ones(len(v), bool))], _STATE)

    return vectors.mapInArrow(run, _STATE)


def _next_pass(state: DataFrame, centroids: np.ndarray, moved: np.ndarray, looser: np.ndarray) -> DataFrame:
    dims = centroids.shape[1]

    def run(batches):
        for batch in batches:
            v = _unpack(batch.column("v"), dims)
            was, upper, lower = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "upper", "lower"))
            cluster, upper, lower, scanned = reassign(v, was, upper, lower, centroids, moved, looser)
            yield _batch([batch.column("vec_id"), batch.column("v"), pa.array(cluster.astype(np.int32)),
                          pa.array(was.astype(np.int32)), pa.array(upper), pa.array(lower), pa.array(scanned)], _STATE)

    return state.mapInArrow(run, _STATE)


def _with_distance(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The exact squared distance of every vector to its centroid."""
    dims = centroids.shape[1]

    def run(batches):
        for batch in batches:
            cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
            d = _own(_unpack(batch.column("v"), dims), centroids, cluster)
            yield _batch([batch.column("vec_id"), batch.column("cluster"), pa.array(d)], _FINAL)

    return state.select("vec_id", "v", "cluster").mapInArrow(run, _FINAL)


def _sum_changes(state: DataFrame, k: int, dims: int) -> np.ndarray:
    """What the vectors that changed cluster add to each cluster's sum: added up within a task,
    then by (cluster, component), so k * dims numbers reach the driver."""

    def run(batches):
        sums = np.zeros((k, dims), np.int64)
        for batch in batches:
            v = _unpack(batch.column("v"), dims)
            cluster, was = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "was"))
            for c in range(k):
                sums[c] += v[cluster == c].sum(axis=0) - v[was == c].sum(axis=0)
        i, j = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(sums[i, j])],
                                         ["cluster", "place", "part"])

    changed = state.where("cluster <> was").select("v", "cluster", "was")
    found = (changed.mapInArrow(run, "cluster int, place int, part long").groupBy("cluster", "place")
             .agg(F.sum("part").alias("part")).toArrow())
    out = np.zeros((k, dims), np.int64)
    out[found["cluster"].to_numpy(), found["place"].to_numpy()] = found["part"].to_numpy()
    return out


def starts(vectors: DataFrame, k: int, seed: str) -> DataFrame:
    """The ``k`` vectors with the smallest hexadecimal SHA-256 of ``seed:vec_id``, in that order
    (a null id reads ``null``; rows of one id by their bytes)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    return vectors.withColumn("h", F.sha2(text.cast("binary"), 256)).orderBy("h", "v").limit(k)


def fit(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = DIMS, scale: float = SCALE,
        k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED) -> tuple[DataFrame, Fit]:
    """(``vec_id, cluster, distance`` of every kept vector, the fit).

    ``rounds`` times all vectors are assigned to their nearest centroid and each non-empty
    centroid is replaced by floor(sum / count) of its vectors; then they are assigned once more.
    Each assignment is one pass from one table of the shared folder to the next (vectors in one
    to four bytes a component, their cluster and bounds), so a lost executor costs its tasks
    only. What reaches the driver are k centroids, k radii and k * dims sums.
    """
    if k < 1 or rounds < 0 or dims < 1:
        raise ValueError("k and dims must be >= 1, rounds >= 0")
    spark: SparkSession = vectors.sparkSession
    whole = integer_vectors(vectors, id_col, vec_col, dims, scale)
    found = _unpack_rows([bytes(r.v) for r in starts(whole, k, seed).collect()], dims)
    done = Fit(found)
    if not len(found):
        return spark.createDataFrame([], _FINAL), done
    root, centroids = shared_path(spark, "centroids"), found
    sums, counts = np.zeros((len(found), dims), np.int64), np.zeros(len(found), np.int64)
    plan = _first_pass(whole, centroids)
    for r in range(rounds + 1):
        at = f"{root}/pass{r}"
        plan.write.option("compression", "zstd").parquet(at)
        state = spark.read.parquet(at)
        counts, radius = np.zeros(len(found), np.int64), np.zeros(len(found))
        scanned = changed = 0
        for row in state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("upper").alias("u"), F.count_if("scanned").alias("s"),
                                                F.count_if(F.col("cluster") != F.col("was")).alias("c")).collect():
            counts[row.cluster], radius[row.cluster] = row.n, row.u
            scanned, changed = scanned + row.s, changed + row.c
        done.scanned.append(scanned)
        done.changed.append(changed)
        if r == rounds:
            break
        sums += _sum_changes(state, len(found), dims)
        moved_to = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], centroids)
        looser = loosening(centroids, moved_to, radius)
        np.fill_diagonal(looser, -np.inf)
        plan = _next_pass(state, moved_to, drifts(centroids, moved_to), looser.max(axis=1))
        centroids = moved_to
    _with_distance(state, centroids).write.option("compression", "zstd").parquet(f"{root}/assigned")
    assigned = spark.read.parquet(f"{root}/assigned")
    done.centroids, done.rows = centroids, int(counts.sum())
    done.inertia = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    return assigned, done


def _unpack_rows(raws: list[bytes], dims: int) -> np.ndarray:
    return _unpack(pa.array(raws, pa.binary()), dims)


def cluster(vectors: DataFrame, **parameters) -> DataFrame:
    """``vec_id, cluster, distance`` (squared), ``cluster_inertia`` and ``inertia`` (distances
    summed over the cluster and over all), ``centroid_sha256`` (of the final centroid's
    components as decimal integers joined by commas). Parameters: see :func:`fit`.

    Vectors that are null, have another length, or hold a null or non-finite component take no
    part; one with an integer component of 2^26 or more is refused (an error, since its distance
    would not fit 64 bits). Every kept row gives a row, repeated ones too; with fewer than ``k``
    kept vectors there are as many centroids as vectors; equal distances go to the smaller
    centroid; an empty table gives no rows; other columns are ignored.
    """
    assigned, done = fit(vectors, **parameters)
    total = sum(done.inertia.values())
    rows = [(c, s, total, sha256(",".join(map(str, done.centroids[c].tolist())).encode()).hexdigest())
            for c, s in sorted(done.inertia.items())]
    table = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row per cluster
    return (assigned.join(F.broadcast(table), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
