"""Namespaces (bronze / silver / gold) and table reads/writes (A5, A6, A9, A11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The three medallion namespaces.
LAYERS = ("bronze", "silver", "gold")


def ensure_schemas(spark: SparkSession, prefix: str = "", layers=LAYERS,
                   location: str | None = None) -> list[str]:
    """``CREATE SCHEMA IF NOT EXISTS`` for each layer; returns the names."""
    names = []
    for layer in layers:
        name = f"{prefix}{layer}"
        loc = f" LOCATION '{location.rstrip('/')}/{name}.db'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`{loc}")
        names.append(name)
    return names


def use_schema(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", comment: str | None = None,
               path: str | None = None) -> None:
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    if comment:
        df.sparkSession.sql(f"COMMENT ON TABLE {name} IS '{comment.replace(chr(39), chr(39) * 2)}'")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def publish_view(df: DataFrame, name: str, comment: str | None = None) -> DataFrame:
    """Named view over a frame (A9), with a comment."""
    df.createOrReplaceTempView(name)
    if comment is not None:
        spark = df.sparkSession
        df.createOrReplaceTempView(f"{name}_rows")
        text = comment.replace("'", "''")
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} COMMENT '{text}' AS SELECT * FROM {name}_rows")
    return df.sparkSession.table(name)
