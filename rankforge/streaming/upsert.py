"""Keyed upsert of a stream (SCD type 1) on Spark's own state (A8, J4-J6).

The newest row per key is a streaming aggregate, ``max(struct(version, tie..., row))`` in update
mode: its state (one row per key, in the state store named by the session) decides what is
newest, so a version that arrives late changes nothing. Each micro-batch gives the newest rows of
the keys it met. They are merged into a table that is partitioned by *bucket*, a function of the
key (a hash, or e.g. the day of a date key): only the buckets that they fall in are read, and
replaced by dynamic partition overwrite.

A batch is first written below the checkpoint (``staged/batch=N``), complete or not at all, and
the table's partitions are replaced from there. A batch that is run again after a crash finds its
staged rows and replaces the same partitions by the same rows, whatever state the crash left them
in; what it would otherwise have to read from them is staged already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.latest import latest_per_key
from .tables import create_table, exists, forget, read_rows, replace_partitions

BUCKET = "_bucket"
NULL_BUCKET = -1

WIDTH = "spark.sql.shuffle.partitions"
#: State partitions for each core. A state partition costs a store to open and files to commit in every
#: micro-batch, whatever it holds, and its keys lie off-heap; adaptive execution does not join them.
STATE_TASKS = 2


@dataclass
class KeyedTable:
    """A named table with one row per ``keys``: the newest by ``version``, then ``tie``, then the
    rest of the row. ``bucket`` maps a row to its bucket (default: a hash of the key into
    ``num_buckets``); it must be a function of the key."""

    name: str
    keys: list[str]
    version: str = "ldts"
    tie: tuple[str, ...] | list[str] = ()
    bucket: Column | None = None
    num_buckets: int = 64
    comment: str | None = None
    path: str | None = None

    def bucket_of(self) -> Column:
        """A NULL bucket (e.g. the day of a NULL date) is a bucket of its own."""
        found = self.bucket if self.bucket is not None else F.pmod(F.xxhash64(*self.keys), F.lit(self.num_buckets))
        return F.coalesce(found.cast("int"), F.lit(NULL_BUCKET))

    def create(self, spark: SparkSession, schema: T.StructType) -> KeyedTable:
        fields = [f for f in schema.fields if f.name != BUCKET] + [T.StructField(BUCKET, T.IntegerType())]
        create_table(spark, self.name, T.StructType(fields), self.comment, self.path, [BUCKET])
        return self

    def read(self, spark: SparkSession, with_bucket: bool = False) -> DataFrame:
        """All rows; a filter on the bucket column (``with_bucket``) prunes partitions."""
        rows = read_rows(spark, self.name)
        return rows if with_bucket else rows.drop(BUCKET)

    def newest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.keys, self.version, list(self.tie))


def stage_batch(spark: SparkSession, changed: DataFrame, table: KeyedTable, staged: str) -> DataFrame:
    """The full new content of the buckets that ``changed`` falls in, written to ``staged`` once.
    ``changed`` itself is computed in every run of a batch: that is what brings the state forward."""
    changed.withColumn(BUCKET, table.bucket_of()).write.mode("overwrite").parquet(f"{staged}/changed")
    if not exists(spark, f"{staged}/merged/_SUCCESS"):
        rows = spark.read.parquet(f"{staged}/changed")
        # the buckets of one batch: a bounded list of small numbers, for partition pruning
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]
        stored = read_rows(spark, table.name).where(F.col(BUCKET).isin(touched))
        merged = latest_per_key(stored.unionByName(rows), [*table.keys, BUCKET], table.version, list(table.tie))
        # adaptive execution cuts a large bucket into several files and joins small ones
        (merged.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET)
         .parquet(f"{staged}/merged"))
    schema = read_rows(spark, table.name).schema
    return spark.read.schema(schema).parquet(f"{staged}/merged")


def publish(merged: DataFrame, table: KeyedTable) -> list[int]:
    """Replace the buckets of ``merged`` in the table; returns them."""
    touched = [r[0] for r in merged.select(BUCKET).distinct().collect()]
    if touched:
        replace_partitions(merged, table.name)
    return touched


def derive(merged: DataFrame, touched: list[int], table: KeyedTable, make: Callable[..., DataFrame]) -> None:
    """Derive the touched buckets of a table made from another row by row (gold from silver). A
    bucket whose rows all fail the other table's rules loses its partition."""
    spark = merged.sparkSession
    made = make(merged.withColumnRenamed(BUCKET, "bucket_of"), keep=["bucket_of"]).withColumnRenamed("bucket_of", BUCKET)
    left = publish(made, table)
    for bucket in set(touched) - set(left):
        spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS PARTITION ({BUCKET}={bucket})")
        forget(spark, f"{_location(spark, table.name)}/{BUCKET}={bucket}")


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0].data_type.rstrip("/")


@contextmanager
def state_width(spark: SparkSession) -> Iterator[None]:
    """Within, a stream that starts a new checkpoint keeps its state in ``STATE_TASKS`` partitions per
    core at most (an old checkpoint keeps its number). The session's width is as before after it."""
    before = spark.conf.get(WIDTH)
    most = STATE_TASKS * max(spark.sparkContext.defaultParallelism, 1)
    spark.conf.set(WIDTH, str(min(int(before), most)))
    try:
        yield
    finally:
        spark.conf.set(WIDTH, before)


def upsert_stream(stream: DataFrame, target: KeyedTable, checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame] | None = None,
                  derived: tuple[KeyedTable, Callable[..., DataFrame]] | None = None) -> None:
    """Run the upsert of ``stream`` (shaped by ``transform``) into ``target`` until the input is
    drained. ``derived`` is a table made from ``target`` row by row, with its function: after each
    batch the buckets that the batch touched are derived anew. Both tables exist from the start.

    The state and the table grow with the keys, not with the stream. A new checkpoint on a table
    that has rows starts with an empty state; the merge still keeps the newest row of each key.
    """
    spark = stream.sparkSession
    shaped = transform(stream) if transform else stream
    target.create(spark, shaped.schema)
    if derived:
        table, make = derived
        table.create(spark, make(spark.createDataFrame([], shaped.schema)).schema)
    place = f"{checkpoint.rstrip('/')}/staged"

    def merge(changed: DataFrame, batch_id: int) -> None:
        merged = stage_batch(spark, changed, target, f"{place}/batch={batch_id}")
        touched = publish(merged, target)
        if derived and touched:
            derive(merged, touched, *derived)
        if batch_id > 0:   # the batch before is committed: it is never run again
            forget(spark, f"{place}/batch={batch_id - 1}")

    writer = (target.newest(shaped).writeStream.outputMode("update").foreachBatch(merge)
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    with state_width(spark):                 # a query takes its settings when it starts
        query = writer.start()
    run_to_completion(query)


def run_to_completion(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise query.exception()
