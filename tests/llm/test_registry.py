"""Registered queries: their SQL on the smallest tables, their columns, the pipeline."""

import os
import sys

import duckdb
import pytest

import corpus_pipeline
from plain import plain_shingles
from rankforge.llm import decontam, langid, neardup, registry

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from check_oracle import TABLES, digest  # noqa: E402

COLUMNS = {
    "op1_voronoi_knn": ["query_id", "rank", "vec_id", "score"],
    "op2_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op3_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op4_decontamination": ["doc_id", "item_id"],
    "op5_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op6_neardup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op7_pseudonyms": ["doc_id", "text"],
    "op8_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op9_html_text": ["page_id", "url", "text", "n_chars"],
    "op10_maxent": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op11_centroids": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
    "op12_filter_audit": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
                          "shapley"],
    "op13_mixing": ["doc_id", "size", "source_size", "target", "taken"],
}


def test_every_operator_is_registered_once():
    assert sorted(registry.QUERIES) == sorted(COLUMNS) and set(registry.ORACLE_SQL) <= set(COLUMNS)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = registry.QUERIES[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(registry.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(rel.columns) and set(COLUMNS[name]) <= set(df.columns)
    assert digest(df.columns, rows)[0] == digest(rel.columns, rel.fetchall())[0]


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(registry.ORACLE_SQL)))
def test_query_has_a_row_for_every_document(spark, sf_small, name):
    df = registry.QUERIES[name](spark, sf_small)
    assert set(COLUMNS[name]) <= set(df.columns)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").count()
    rows = df.where("start = 0").count() if name == "op3_packing" else df.count()
    assert rows == docs


def test_pipeline_stages_take_effect(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_small).checkpoint()
        kept[name] = docs
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "MinHash near-dedup", "benchmark decontamination", "PII", "packing"]
    columns = spark.read.parquet(f"{sf_small}/documents.parquet").columns
    assert all(kept[n].columns == columns for n in list(kept)[:-1])
    first, second, third, fourth, last = kept.values()
    groups = neardup.groups(first)
    assert {r.doc_id for r in groups.where("kept").collect()} == {r.doc_id for r in second.collect()}
    found = {r.doc_id for r in decontam.leaks(second, items).collect()}
    assert {r.doc_id for r in third.collect()} == {r.doc_id for r in second.collect()} - found and found
    want = [plain_shingles(r.text, 5) for r in items.collect()]
    for r in third.collect():
        have = plain_shingles(r.text, 5)
        assert not any(w and 100 * len(w & have) >= 80 * len(w) for w in want)
    assert fourth.count() == third.count()
    assert {r.doc_id for r in last.collect()} == {r.doc_id for r in fourth.collect()}


def test_language_stage_keeps_clean_documents_and_rejects_others(spark):
    rows = [(k, f"the quick brown fox jumps over the lazy dog {k}", "en", "s", 0) for k in range(20)]
    rows += [(100, None, "en", "s", 0), (101, "12345 6789 !!", "en", "s", 0), (102, "щщщ жжж ююю", None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.language_stage(spark, docs, "")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(20))
    assert langid.UNKNOWN == "und"


def test_run_on_empty_documents(spark, sf_small, tmp_path):
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{sf_small}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
