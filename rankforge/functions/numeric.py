"""Numeric helpers (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def roundfloat(col: Column | str, decimals: int = 2) -> Column:
    """Round half-up to ``decimals`` places, then narrow to a 32-bit float."""
    return F.round(_col(col), decimals).cast("float")


def ms_to_seconds(col: Column | str) -> Column:
    """Milliseconds to whole seconds, truncating (485999 -> 485)."""
    return (_col(col) / 1000).cast("int")


def safe_cast(col: Column | str, dtype: str) -> Column:
    """Cast that yields NULL instead of failing on bad text (ANSI mode raises on ``cast``)."""
    return _col(col).try_cast(dtype)
