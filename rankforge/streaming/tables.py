"""Named tables that streams append to and read from (A5, A7).

A table is created once, with its comment, before the first row arrives, and exists from then on:
a reader meets the rows of all finished batches, never a missing table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def as_nullable(dtype: T.DataType) -> T.DataType:
    """The same type with every field nullable (what a file table stores)."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, as_nullable(f.dataType), True, f.metadata)
                             for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(as_nullable(dtype.elementType), True)
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, as_nullable(dtype.valueType), True)
    return dtype


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _place(spark, path)
    return fs.exists(place)


def forget(spark: SparkSession, path: str) -> None:
    """Delete a path with all below it, if it is there."""
    fs, place = _place(spark, path)
    fs.delete(place, True)


def create_table(spark: SparkSession, name: str, schema: T.StructType, comment: str | None = None,
                 path: str | None = None, partition_by: Iterable[str] = ()) -> str:
    """``CREATE TABLE IF NOT EXISTS`` as parquet; with ``path`` at that place, and then partitions
    that are there already (of an earlier session) are found again. Returns the name."""
    parts = list(partition_by)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in as_nullable(schema).fields)
    text = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if parts:
        text += f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})"
    if comment is not None:
        text += " COMMENT '" + comment.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if path is not None:
        text += f" LOCATION '{path}'"
    found = path is not None and not spark.catalog.tableExists(name) and exists(spark, path)
    spark.sql(text)
    if parts and found:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def read_rows(spark: SparkSession, name: str) -> DataFrame:
    """A table's rows as of the last finished batch (file listings are looked up anew)."""
    spark.catalog.refreshTable(name)
    return spark.read.table(name)


def read_table_stream(spark: SparkSession, name: str) -> DataFrame:
    """Stream read of a table that streams append to (A5)."""
    return spark.readStream.table(name)


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Within, an overwriting insert replaces the partitions that it has rows for, no others."""
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def replace_partitions(rows: DataFrame, name: str) -> None:
    """Put ``rows`` in place of the partitions of the table that they fall in."""
    spark = rows.sparkSession
    with dynamic_overwrite(spark):
        rows.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)
