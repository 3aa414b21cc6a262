"""Surrogate key: SHA-256 over the key columns, each written with its length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols: Column | str) -> Column:
    """Every part is written as ``<characters>:<text>``, a NULL part as ``-``, so different
    tuples never give the same text, whatever characters their parts hold."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)
