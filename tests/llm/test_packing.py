"""Power-of-two packing against the tokenizer itself."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rankforge.llm import packing, registry
from rankforge.llm.frames import text_buffer

SCHEMA = "doc_id long, text string, length int, ids string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(registry.vocabulary())


def test_encoder_equals_the_tokenizer(tokenizer):
    rng = random.Random(2)
    bits = [" ", "  ", "\n", "\t", " \n", "a", "B", "é", "1", "22", "'s", "'", ".", "…", "漢", "　", "\x1c", "\x85", "-",
            "🙂", "\r\n", "don't", "word", "\xa0"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + [None, ""]
    enc = packing.Encoder(registry.vocabulary())
    for _ in range(2):                                   # the second time from its memory
        ids, bounds = enc.encode(*text_buffer(pa.array(texts, pa.string())))
        for k, t in enumerate(texts):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_added_tokens_are_taken_from_the_text(tokenizer):
    rng = random.Random(3)
    bits = [" ", "  ", "\n", "a", "é", "don't", " word", "<|endoftext|>", "<|endoftext|>", "<|endoftext", "|>", "<|", "<"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 10))) for _ in range(2000)]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", "x <|endof", "text|> y", None, ""]
    enc = packing.Encoder(registry.vocabulary())
    for _ in range(2):
        ids, bounds = enc.encode(*text_buffer(pa.array(texts, pa.string())))
        for k, t in enumerate(texts):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, repr(t)
    ids, _ = enc.encode(*text_buffer(pa.array(["a <|endoftext|> b"])))
    assert ids.tolist() == [64, 220, 50256, 275]


def test_packed_documents_hold_added_tokens(spark, tokenizer):
    text = "one <|endoftext|> two " * 400
    found = packing.pack(spark.createDataFrame([(1, text, 0, "x")], SCHEMA), registry.vocabulary()).orderBy("start").collect()
    want = tokenizer.encode(text, add_special_tokens=False).ids + [0]
    assert sum((r.ids for r in found), []) == want and want.count(50256) == 400
    assert {r.doc_tokens for r in found} == {len(want)}


@pytest.mark.parametrize("n", [1, 2, 7, 1023, 1024, 1025, 5000])
def test_piece_lengths(n):
    got = packing.piece_lengths(n)
    assert sum(got) == n and all(k & (k - 1) == 0 and k <= 1024 for k in got) and got == sorted(got, reverse=True)


def test_pieces_are_an_exact_round_trip(spark, tokenizer):
    rows = [(1, "the cat sat on the mat. " * 300, 0, "x"), (2, None, 0, "x"), (3, "", 0, "x"), (None, "a b", 0, "x"),
            (1, "other text of the same id", 0, "x"), (1, "other text of the same id", 0, "x")]
    found = packing.pack(spark.createDataFrame(rows, SCHEMA), registry.vocabulary()).collect()
    want = sorted(tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for _, t, *_ in rows)
    docs, seen = [], []
    for r in sorted(found, key=lambda r: r.sequence_id):
        assert r.length == len(r.ids) == r.bucket and r.offset == 0 and r.length & (r.length - 1) == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        if r.start == 0:
            docs.append([])
        assert r.start == len(docs[-1])
        docs[-1] += r.ids
        seen.append(r.sequence_id)
        if len(docs[-1]) == r.doc_tokens:
            continue
    assert sorted(docs) == want and len(set(seen)) == len(seen)
    thin = packing.pack(spark.createDataFrame(rows, SCHEMA), registry.vocabulary(), with_ids=False)
    assert sorted(r.ids_crc32 for r in thin.collect()) == sorted(r.ids_crc32 for r in found)


def test_empty_table_buckets_and_bad_length(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.pack(empty, registry.vocabulary()).count() == 0
    docs = spark.createDataFrame([(1, "a b c", 0, "")], SCHEMA)
    packing.write_buckets(packing.pack(docs, registry.vocabulary()), str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).where("size(ids) <> bucket").count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, registry.vocabulary(), max_length=1000)
