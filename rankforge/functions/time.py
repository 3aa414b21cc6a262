"""Time helpers (Column -> Column). They assume the session zone is pinned to UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Divisor that turns an epoch number of each unit into seconds.
EPOCH_UNITS = {"s": 1, "ms": 1_000, "us": 1_000_000}

# Fixed value: accepted layout of local date-time text for ``*_time`` fields.
LOCAL_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_timestamp(col: Column | str, unit: str = "s") -> Column:
    """Epoch number -> timestamp at whole-second precision.

    The sub-second part is dropped, truncating toward zero (-1500 ms -> 23:59:59 the day
    before), with no text round trip.
    """
    key = unit.lower().strip()
    if key not in EPOCH_UNITS:
        raise ValueError(f"epoch unit {unit!r} is none of {', '.join(EPOCH_UNITS)}")
    return F.timestamp_seconds((_col(col) / F.lit(EPOCH_UNITS[key])).cast("bigint"))


def local_text_to_epoch_ms(col: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> epoch milliseconds as double (session zone).
    Badly formed text raises (ANSI ``to_timestamp``)."""
    ts = F.to_timestamp(_col(col), LOCAL_TIME_FORMAT)
    return (F.unix_seconds(ts) * F.lit(1000)).cast("double")


def normalize_epoch_ms(col: Column | str, dtype: T.DataType) -> Column:
    """Text in the local layout becomes epoch ms; numbers pass through as double."""
    if isinstance(dtype, T.StringType):
        return local_text_to_epoch_ms(col)
    if isinstance(dtype, T.NumericType):
        return _col(col).cast("double")
    raise TypeError(f"cannot normalise a {dtype.simpleString()} time field")


def normalize_time_fields(df: DataFrame, suffix: str = "_time") -> DataFrame:
    """Apply :func:`normalize_epoch_ms` to every top-level column whose name ends in
    ``suffix``; other columns are left untouched."""
    changes = {
        f.name: normalize_epoch_ms(F.col(f.name), f.dataType)
        for f in df.schema.fields if f.name.endswith(suffix)
    }
    return df.withColumns(changes) if changes else df


def date_text(col: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(_col(col), pattern)


def minutes_seconds(seconds: Column | str, truncate: bool = True) -> Column:
    """Seconds -> ``MM:SS``.

    Each part is left-padded to two characters. With ``truncate=True`` (the published
    behaviour) ``lpad`` also cuts longer parts, so 6000 s gives ``10:00`` and -5 s gives
    ``-1:-5``; ``truncate=False`` keeps long parts whole (6000 s -> ``100:00``).
    """
    s = _col(seconds)
    mm = F.floor(s / 60).cast("string")
    ss = (s % 60).cast("string")
    if truncate:
        mm_p, ss_p = F.lpad(mm, 2, "0"), F.lpad(ss, 2, "0")
    else:
        mm_p = F.when(F.length(mm) >= 2, mm).otherwise(F.lpad(mm, 2, "0"))
        ss_p = F.when(F.length(ss) >= 2, ss).otherwise(F.lpad(ss, 2, "0"))
    return F.concat(mm_p, F.lit(":"), ss_p)
