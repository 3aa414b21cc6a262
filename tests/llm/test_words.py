"""Word and shingle hashes against plain Python."""

import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from plain import plain_words
from rankforge.llm import frames, words as W

TEXTS = st.lists(st.text(alphabet="aAbÉé \t\n\x0b\x0c\r\x1c\xa0|", max_size=40) | st.none(), max_size=12)


def _words(texts):
    return W.words(*frames.text_buffer(pa.array(texts, pa.string())))


@settings(max_examples=60, deadline=None)
@given(texts=TEXTS)
def test_words_and_shingles_equal_python(texts):
    hashes, bounds, _ = _words(texts)
    want = [plain_words(t) for t in texts]
    assert np.diff(bounds).tolist() == [len(w) for w in want]
    seen = {}
    for w, h in zip((x for ws in want for x in ws), hashes.tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    flat, sb = W.shingles(hashes, bounds, 2)
    for k, ws in enumerate(want):
        n = max(len(ws) - 1, 1) if ws else 0
        assert sb[k + 1] - sb[k] == n
    found, fb = W.distinct(flat, sb)
    for k, ws in enumerate(want):
        pairs = set(zip(ws, ws[1:])) if len(ws) > 1 else {tuple(ws)} if ws else set()
        assert fb[k + 1] - fb[k] == len(pairs)


def test_windows_do_not_matter(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab \n") for _ in range(rng.randint(0, 90))) for _ in range(50)] + ["x" * 500, "", None]
    whole = _words(texts)
    monkeypatch.setattr(W, "WINDOW", 32)
    monkeypatch.setattr(W, "LONG", 8)
    cut = _words(texts)
    assert (whole[1] == cut[1]).all() and (whole[2] == cut[2]).all()
    again = _words(texts)
    assert (cut[0] == again[0]).all()


def test_slices_bound_text_but_keep_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 200, 0, 7, 90, 1)])], ["text"])
    parts = list(frames.slices(batch, "text", 100))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert all(p.num_rows == 1 or sum(map(len, p.column("text").to_pylist())) <= 100 for p in parts)


def test_key_filter_and_ship(spark):
    df = spark.range(0, 2000, 7).withColumnRenamed("id", "k")
    bitmap = frames.key_filter(df, "k")
    probe = spark.range(2000).select("id", frames.hashed("id").alias("h")).toPandas()
    inside = frames.passes(bitmap, probe.h.to_numpy())
    assert inside[probe.id % 7 == 0].all() and inside.mean() < 0.2
    assert not frames.key_filter(df.limit(0), "k").any()
