"""Column -> Column helpers shared by batch and streaming plans."""

from .keys import surrogate_key
from .numeric import ms_to_seconds, roundfloat, safe_cast
from .text import capitalize_words, empty_to_null, to_title_case, trim_whitespace
from .time import (date_text, epoch_to_timestamp, local_text_to_epoch_ms, minutes_seconds,
                   normalize_epoch_ms, normalize_time_fields)

__all__ = [
    "capitalize_words", "date_text", "empty_to_null", "epoch_to_timestamp",
    "local_text_to_epoch_ms", "minutes_seconds", "ms_to_seconds", "normalize_epoch_ms",
    "normalize_time_fields", "roundfloat", "safe_cast", "surrogate_key", "to_title_case",
    "trim_whitespace",
]
