"""Text clean-up helpers (Column -> Column), all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where a new word starts in an identifier of each style.
WORD_STARTS = {
    "pascal": "(?<=[a-z])(?=[A-Z])",
    "snake": "_+",
    "kebab": "-+",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_title_case(col: Column | str, case: str) -> Column:
    """Words of an identifier, separated by blanks, each with an upper-case first letter and
    the rest lower-cased: ``BlueOtter`` (pascal), ``blue__otter`` (snake) and ``blue-otter``
    (kebab) all give ``Blue Otter``. The style may be written in any case and padded with
    blanks; one that is not known raises ``ValueError``."""
    starts = WORD_STARTS.get(case.strip().lower())
    if starts is None:
        raise ValueError(f"no word rule for identifier style {case!r}; known styles: {', '.join(WORD_STARTS)}")
    return capitalize_words(F.regexp_replace(_col(col), starts, " "))


def trim_whitespace(col: Column | str) -> Column:
    """CR/LF become spaces, runs of whitespace become one space, both ends trimmed.
    The whitespace class covers CR and LF, so one replacement does both."""
    return F.trim(F.regexp_replace(_col(col), r"\s+", " "))


def capitalize_words(col: Column | str) -> Column:
    """``initcap``: words split on spaces only, the rest of each word lower-cased."""
    return F.initcap(_col(col))


def empty_to_null(col: Column | str) -> Column:
    return F.nullif(_col(col), F.lit(""))
