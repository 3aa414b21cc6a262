"""A training-data pipeline over ``documents``.

Five stages, each working on all rows that the stage before it kept: language identification
(a text without a recognisable language goes), near-duplicate groups (the document with the
smallest id of each stays), benchmark decontamination (a document that holds a test item
goes), pseudonyms for personal data, packing into token sequences. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import decontam, langid, neardup, packing, pii, registry
from rankforge.llm.frames import load
from rankforge.session import shared_path

#: Least corrected share of a text's trigrams that its language must know; texts in one of
#: the learned languages are far above it, even those of a few words.
MIN_SCORE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents written in one of the languages of the labelled ones."""
    model = langid.train(docs.select("text", "lang"))
    found = langid.predict(docs, model)
    return found.where(found["lang_pred"] != langid.UNKNOWN).where(found["score"] >= MIN_SCORE).select(*docs.columns)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group (shingles of five words, 0.8)."""
    return neardup.one_per_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no benchmark item."""
    return decontam.clean(docs, load(spark, sf_dir, "benchmark"))


def pseudonym_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by pseudonyms; every document stays, ``n_chars`` follows its text."""
    found = pii.pseudonymise(docs, registry.PSEUDONYM_KEY, count_col=None)
    return found.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths, with their ids."""
    return packing.pack(docs, registry.vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_stage),
    ("MinHash near-dedup", neardup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", pseudonym_stage),
    ("packing", packing_stage),
]

#: No SQL: trained filters, keyed pseudonyms and token ids cannot be expressed in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each one's rows written as Parquet to the shared
    folder and read by the next."""
    root = shared_path(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/stage{k}")
        docs = spark.read.parquet(f"{root}/stage{k}")
    return docs
