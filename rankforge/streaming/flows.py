"""Structured Streaming flows: landing files -> bronze table -> silver-clean table -> silver
upsert target.

Each hop is one streaming query run to completion with ``trigger(availableNow=True)``; the
checkpoint of each query remembers which files it has consumed, so a rerun picks up only new
input (exactly-once file discovery). Hops are chained by the names of their tables. The
transforms are the same ``DataFrame -> DataFrame`` functions as in batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import expect_or_drop, reject
from ..sources.files import attach_metadata, stream_landing
from .tables import OVERWRITE_MODE, create_table
from .upsert import run_to_completion

#: Column of a checked table that holds the micro-batch of a row.
BATCH = "_batch"

LEDGER = T.StructType([T.StructField(name, kind) for name, kind in (
    ("rule", T.StringType()), ("rows_tested", T.LongType()), ("rows_failed", T.LongType()),
    ("query", T.StringType()), ("batch", T.LongType()))])


@dataclass(frozen=True)
class Rejected:
    """Where rows go that fail a rule: the table, what is kept of a row, comment and place."""

    table: str
    shape: Callable[[DataFrame], DataFrame]
    comment: str | None = None
    path: str | None = None


def bronze_stream(spark: SparkSession, landing_dir: str, dataset: str, source: str,
                  ldts: Column | None = None, layout: str = "lines",
                  max_files_per_trigger: int | None = None, **reading) -> DataFrame:
    """Incremental scan of the landing folder with load metadata (A2 + A3); ``reading``: further
    arguments of :func:`rankforge.sources.files.stream_landing`."""
    return attach_metadata(stream_landing(spark, landing_dir, dataset, True, layout, max_files_per_trigger, **reading),
                           source, ldts)


def append_to_table(stream: DataFrame, table: str, checkpoint: str, comment: str | None = None,
                    path: str | None = None) -> None:
    """Append-only streaming table (A7), created once with its comment, run until the input is
    drained. The sink's own log makes every row appear once."""
    create_table(stream.sparkSession, table, stream.schema, comment, path)
    run_to_completion(stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
                      .trigger(availableNow=True).toTable(table))


def create_ledger(spark: SparkSession, ledger: str, path: str | None = None) -> str:
    """The table of rule counts: one row per query, micro-batch and rule."""
    return create_table(spark, ledger, LEDGER, "Rows tested and failed by each rule of each micro-batch.", path,
                        ["query", "batch"])


def append_checked(stream: DataFrame, rules: Mapping[str, str], table: str, ledger: str, query: str, checkpoint: str,
                   comment: str | None = None, path: str | None = None, ledger_path: str | None = None,
                   shape: Callable[[DataFrame], DataFrame] | None = None,
                   rejected: Rejected | None = None) -> None:
    """Append the rows that pass every rule to ``table`` and each micro-batch's counts, taken
    while its rows are written, to ``ledger`` (D6, J2), until the input is drained.

    Rows carry their micro-batch, a partition of the table, and counts are a partition per query
    and micro-batch: a batch that is run again replaces what it wrote before, rows and counts. A
    stream that reads the table sees its rows again then (a keyed upsert ignores them). The counts
    are observed metrics: an executor lost in the middle of a write can make them count the
    recomputed rows again.

    ``shape`` selects the columns of the rows that pass. ``rejected`` names a second table for those
    that do not (with what is kept of them), written by the same micro-batch.
    """
    spark = stream.sparkSession
    shape = shape or (lambda rows: rows)

    def make(name: str, rows: DataFrame, text: str | None, place: str | None) -> None:
        create_table(spark, name, T.StructType([*rows.schema.fields, T.StructField(BATCH, T.LongType())]), text, place, [BATCH])

    make(table, shape(stream), comment, path)
    if rejected:
        make(rejected.table, rejected.shape(stream), rejected.comment, rejected.path)
    create_ledger(spark, ledger, ledger_path)

    def write(rows: DataFrame, batch_id: int) -> None:
        own = rows.sparkSession            # the stream's private session
        own.conf.set(OVERWRITE_MODE, "dynamic")
        seen = Observation()
        number = F.lit(batch_id).cast("long")
        shape(expect_or_drop(rows, rules, seen)).withColumn(BATCH, number).write.insertInto(table, overwrite=True)
        if rejected:
            rejected.shape(reject(rows, rules)).withColumn(BATCH, number).write.insertInto(rejected.table, overwrite=True)
        found = seen.get
        counts = [(rule, found["rows_tested"], found[f"failed_{rule}"], query, batch_id) for rule in rules]
        own.createDataFrame(counts, LEDGER).coalesce(1).write.insertInto(ledger, overwrite=True)

    run_to_completion(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
                      .trigger(availableNow=True).start())


def ledger_totals(spark: SparkSession, ledger: str, query: str | None = None) -> DataFrame:
    """``query, rule, rows_tested, rows_failed``: the counts of all micro-batches."""
    spark.catalog.refreshTable(ledger)
    rows = spark.read.table(ledger)
    if query is not None:
        rows = rows.where(F.col("query") == query)
    return rows.groupBy("query", "rule").agg(F.sum("rows_tested").alias("rows_tested"), F.sum("rows_failed").alias("rows_failed"))
