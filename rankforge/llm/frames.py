"""Small shared helpers: narrow inputs, Arrow batches, checkpoints in the shared folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: Text bytes of one slice of an Arrow batch; the arrays derived from a slice take about
#: forty times as much, whatever the number of rows Spark puts in a batch.
SLICE_BYTES = 2 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(root)
    target = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    out.write(full, os.path.join(name, os.path.relpath(full, root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` is called so (case aside)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there: later jobs
    neither recompute it nor depend on an executor's disk."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1]
    off = off.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch with at most ``limit`` bytes of text each, or one row."""
    if batch.num_rows == 0:
        return
    _, off = text_buffer(batch.column(text))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(off, off[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def map_text(df: DataFrame, text: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]],
             schema: str, limit: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` over slices of bounded text size. ``make()`` is called once per task
    and returns the function from a slice to an output batch (or None)."""

    ship(df.sparkSession)

    def run(batches):
        one = make()
        for batch in batches:
            for part in slices(batch, text, limit):
                out = one(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def in_sample(column: str, modulus: int) -> F.Column:
    """crc32(id as text) mod ``modulus`` is 0; a null id counts as not held out."""
    crc = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(crc % F.lit(modulus) == 0, F.lit(False))


# ------------------------------------------------------------------ bounded filters
#: Bits of a membership filter: 4 MB, whatever the number of keys. A full filter only lets
#: more rows pass; an exact join always follows.
FILTER_BITS = 25


def key_filter(keys: DataFrame, column: str, places: F.Column | None = None) -> np.ndarray:
    """A bitmap over the hashes of a long column (or over ``places``). Equal words of the bitmap are combined on
    the executors; at most 2 ** (FILTER_BITS - 6) of them reach the driver."""
    words = (keys.where(F.col(column).isNotNull()).withColumn("_h", hashed(column) if places is None else places)
             .selectExpr("_h >> 6 AS w", "shiftleft(1L, _h & 63) AS bit")
             .groupBy("w").agg(F.bit_or("bit").alias("bits")))
    found = words.toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[found["w"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64)


def hashed(column: str) -> F.Column:
    """The hash that ``passes`` looks up."""
    return F.shiftrightunsigned(F.xxhash64(column), 64 - FILTER_BITS).cast("int")


def passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash of ``hashed`` may be among the keys of the bitmap."""
    return (bitmap[hashes >> 6] >> (hashes & 63).astype(np.uint64)) & np.uint64(1) == 1
