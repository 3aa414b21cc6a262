"""Newest row per key (SCD type 1 view of a versioned table).

Expressed as one aggregate, ``max(struct(version, tie..., rest...))`` per key, rather than
a ``row_number`` window: the aggregate has a map-side partial phase, so a key holding a
third of all rows is reduced to one row per map task before the shuffle, and the same
expression is legal on a stream. Struct comparison puts NULL first, so ``max`` equals
``ORDER BY version DESC NULLS LAST, tie DESC NULLS LAST, ...``; the remaining columns close
every tie deterministically. NULL keys are a group of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], version: str | list[str] = "ldts",
                   tie: list[str] = ()) -> DataFrame:
    order = [version] if isinstance(version, str) else list(version)
    order += [c for c in tie if c not in order]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_newest")
    newest = df.groupBy(*keys).agg(F.max(packed).alias("_newest"))
    return newest.select(*[F.col(k) for k in keys],
                         *[F.col(f"_newest.{c}").alias(c) for c in order + rest]).select(*df.columns)
