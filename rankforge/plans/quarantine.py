"""Documents that cannot be read: told apart from those that hold nothing, kept and counted.

A cut-off line has no payload and a cut-off payload gives no records; without a second look both
are as silent as an empty document. Reading with a corrupt-record column (of the landed line, and
of the payload's declared schema) names the reason; readable documents go on, the others to a
table of their own with their text, source and load time, from which they can be repaired.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.quality import expectation_report

CORRUPT = "_corrupt_record"
REASON = "broken"

# The rule that a readable document meets, and the reasons for which one is broken.
RULES = {"readable_document": f"{REASON} IS NULL"}
LINE, PAYLOAD = "line", "payload"


def unreadable(text: Column, payload: T.StructType) -> Column:
    """Whether a payload text is no document of the schema: malformed, and not one field of it
    could be read. (A malformed value inside a readable document only makes its field NULL.)"""
    fields = [f.name for f in payload.fields]
    schema = T.StructType([*payload.fields, T.StructField(CORRUPT, T.StringType())])
    read = F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT})
    return read[CORRUPT].isNotNull() & reduce(lambda a, b: a & b, [read[f].isNull() for f in fields])


def _parsed(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.VariantType)


def mark_broken(bronze: DataFrame, dataset: str = "encounters") -> DataFrame:
    """Add ``broken``: ``line`` when the landed line was no JSON (its text is in the corrupt-record
    column that :func:`rankforge.sources.files.read_landing` adds on request), ``payload`` when the
    payload cannot be read, else NULL. A NULL payload without a corrupt line holds nothing and is
    not broken. No shuffle; one more parse of a payload held as text, none of a VARIANT (which is broken
    when it holds no object)."""
    column, payload = schemas.PAYLOADS[dataset]
    if _parsed(bronze, column):
        bad = ~F.is_variant_null(column) & F.try_variant_get(F.col(column), "$", "map<string,variant>").isNull()
    else:
        bad = unreadable(F.col(column), payload)
    reason = F.when(F.col(column).isNotNull() & bad, F.lit(PAYLOAD))
    if CORRUPT in bronze.columns:
        reason = F.when(F.col(CORRUPT).isNotNull(), F.lit(LINE)).otherwise(reason)
    return bronze.withColumn(REASON, reason)


def readable(marked: DataFrame) -> DataFrame:
    """The documents that go on, in the columns of bronze."""
    return marked.where(F.col(REASON).isNull()).drop(REASON, CORRUPT)


def quarantined(marked: DataFrame, dataset: str = "encounters") -> DataFrame:
    """The others: ``document`` (the text as it came; of a VARIANT its JSON), ``broken``, ``ldts``, ``rsrc``."""
    column, _ = schemas.PAYLOADS[dataset]
    payload = F.to_json(column) if _parsed(marked, column) else F.col(column)
    text = F.coalesce(F.col(CORRUPT), payload) if CORRUPT in marked.columns else payload
    return marked.where(F.col(REASON).isNotNull()).select(text.alias("document"), REASON, "ldts", "rsrc")


def document_report(marked: DataFrame) -> DataFrame:
    """Documents tested, failed and passed, as for any other rule; one scan."""
    return expectation_report(marked, RULES)
