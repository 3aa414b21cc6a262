"""Packing by power-of-two decomposition.

A document's token ids (with the separator id at its end) are cut into whole sequences of
``max_length`` ids and then into pieces whose lengths are the powers of two of the rest, the
longest first. Every piece is a sequence of its own and equal lengths form a bucket, so no
sequence crosses documents and none needs padding. No shuffle is needed: a document's pieces
depend on that document alone.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_text, text_buffer
from .words import U, spans

MAX_LENGTH = 1024
SEPARATOR = 0
#: Text bytes whose words are encoded together.
SLICE_BYTES = 8 << 20
#: Runs whose ids a worker remembers from slice to slice; any other is encoded again.
REMEMBERED = 400_000


class Encoder:
    """Token ids of many texts under a byte-level BPE vocabulary.

    The pre-tokenizer always cuts before a space that a non-space follows, so ids of the runs
    between such places can be put together. A slice of texts is cut there, each distinct run
    is encoded once, all of them in one string, and the ids are gathered back. (A run at the
    start of a text has no leading space and is encoded on its own.) The vocabulary's added
    tokens are taken from the text first, as its tokenizer does; the parts between them are
    encoded like texts.
    """

    def __init__(self, vocabulary: str):
        import tiktoken
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(vocabulary)
        added = {t.content for t in tok.get_added_tokens_decoder().values()}
        # The longest first, as where several begin at one place the tokenizer takes that.
        self._added = {t.content.encode(): i for i, t in tok.get_added_tokens_decoder().items()}
        for t in tok.get_added_tokens_decoder().values():
            if t.lstrip or t.rstrip or t.single_word:
                raise ValueError(f"the added token {t.content!r} takes more than its own text")
        names = sorted(self._added, key=len, reverse=True)
        self._find = re.compile(b"|".join(map(re.escape, names))) if names else None
        byte = _byte_names()
        ranks = {bytes(byte[c] for c in name): i
                 for name, i in tok.get_vocab(with_added_tokens=False).items() if name not in added}
        # Fixed value: the pre-tokenizer pattern of the byte-level vocabulary.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self._bpe = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._width = np.zeros(max(ranks.values()) + 1, np.int64)
        for name, i in ranks.items():
            self._width[i] = len(name)
        none = np.zeros(1, np.int64)
        self._memory = (np.zeros(1, U), none, none, np.zeros(0, np.uint32))
        # A byte after a space that certainly starts no white space; where it could (the
        # first bytes of longer white space characters), the run just goes on.
        self._solid = np.ones(256, bool)
        self._solid[:0x21] = False
        self._solid[[0xC2, 0xE1, 0xE2, 0xE3]] = False

    def ids(self, data: bytes) -> np.ndarray:
        return np.array(self._bpe.encode_ordinary(data.decode("utf-8")), np.int64)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of text ``d`` are ``ids[bounds[d]:bounds[d + 1]]``."""
        data = raw.tobytes()
        if self._find is None or not self._find.search(data):
            return self._ordinary(raw, offsets)
        # The parts between added tokens, each with the added token that follows it or -1.
        parts, after, first = [], [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            first.append(len(parts))
            for m in self._find.finditer(data, a, b):
                parts.append(data[a:m.start()])
                after.append(self._added[m[0]])
                a = m.end()
            parts.append(data[a:b])
            after.append(-1)
        first.append(len(parts))
        after = np.array(after, np.int64)
        ids, bounds = self._ordinary(np.frombuffer(b"".join(parts), np.uint8),
                                     np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64))
        some = after >= 0
        ids = np.insert(ids, bounds[1:][some], after[some].astype(ids.dtype))
        return ids, (bounds + np.concatenate([[0], np.cumsum(some)]))[first]

    def _ordinary(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of texts without added tokens."""
        cut = np.zeros(len(raw) + 1, bool)
        cut[:-2] = (raw[:-1] == 0x20) & self._solid[raw[1:]]
        first = np.unique(offsets[:-1][np.diff(offsets) > 0])
        cut[first], cut[-1] = True, False
        starts = np.flatnonzero(cut)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(raw))
        low = np.zeros(len(raw) + 8, np.uint8)
        low[:len(raw)] = raw
        key = spans(low, starts, ends - starts)
        key[np.searchsorted(starts, first)] ^= U(1) << U(63)
        which, distinct = pd.factorize(key)
        example = np.zeros(len(distinct), np.int64)
        example[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        begin, count, flat = self._kept(distinct)
        new = np.flatnonzero(count < 0)
        alone = new[np.isin(starts[example[new]], first)]
        joined = new[~np.isin(starts[example[new]], first)]
        data = raw.tobytes()
        text = lambda rows: [data[a:b] for a, b in zip(starts[example[rows]].tolist(), ends[example[rows]].tolist())]
        own = [self.ids(piece) for piece in text(alone)]
        met = self.ids(b"".join(text(joined)))
        # The ids' byte widths show where each run's ids begin.
        stop = np.searchsorted(np.cumsum(self._width[met]), np.cumsum((ends - starts)[example[joined]])) + 1
        count[joined] = np.diff(stop, prepend=0)
        begin[joined] = len(flat) + stop - count[joined]
        count[alone] = [len(x) for x in own]
        begin[alone] = len(flat) + len(met) + np.cumsum(count[alone]) - count[alone]
        flat = np.concatenate([flat, met, *own]).astype(np.uint32)
        self._keep(distinct, begin, count, flat, joined[np.bincount(which)[joined] > 1])
        n = count[which]
        upto = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(begin[which] - upto[:-1], n) + np.arange(upto[-1])
        return flat[at], upto[np.searchsorted(starts, offsets)]

    def _kept(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of runs met before are: (begin, count or -1, ids)."""
        have, begin, count, flat = self._memory
        at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
        found = have[at] == keys
        return np.where(found, begin[at], 0), np.where(found, count[at], -1), flat

    def _keep(self, keys, begin, count, flat, rows) -> None:
        """Remember the ids of ``rows``, while there is room."""
        have, old_begin, old_count, old = self._memory
        rows = rows[:max(0, REMEMBERED - len(have))]
        if len(rows):
            n = count[rows]
            upto = np.concatenate([[0], np.cumsum(n)])
            ids = flat[np.repeat(begin[rows] - upto[:-1], n) + np.arange(upto[-1])]
            have = np.concatenate([have, keys[rows]])
            order = np.argsort(have)
            self._memory = (have[order], np.concatenate([old_begin, len(old) + upto[:-1]])[order],
                            np.concatenate([old_count, n])[order], np.concatenate([old, ids]))


def _byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself
    where it is visible Latin-1, else the next free character from 256 on."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    names = {chr(b): b for b in seen}
    names |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(seen))}
    return names


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def piece_lengths(n: int, max_length: int = MAX_LENGTH) -> list[int]:
    """Whole sequences first, then the binary digits of the rest, the longest first."""
    rest = n % max_length
    return [max_length] * (n // max_length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text",
         max_length: int = MAX_LENGTH, separator: int = SEPARATOR, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (ids of the document before it), ``length``,
    ``ids_crc32``, ``doc_tokens`` (with the separator), ``sequence_id``, ``offset`` (always 0:
    a piece fills its sequence), ``bucket`` (the length class, equal to the length) and, with
    ``with_ids``, ``ids``.

    A null or empty text is the separator alone (one piece of length 1); a null id is kept;
    repeated rows are packed once each; an empty table gives no rows; further columns are
    ignored; a text of any length is encoded whole. ``max_length`` is a power of two.
    ``sequence_id`` is unique, rising within a partition of the input.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError(f"max_length must be a power of two, not {max_length}")

    def make():
        enc = encoder(vocabulary)

        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            ids, bounds = enc.encode(*text_buffer(part.column("text")))
            # every text's ids, then the separator
            ids = np.insert(ids, bounds[1:], separator).astype("<u4")
            total = np.diff(bounds) + 1
            lengths = [piece_lengths(n, max_length) for n in total.tolist()]
            row = np.repeat(np.arange(len(total)), [len(x) for x in lengths])
            length = np.array([k for x in lengths for k in x], np.int64)
            stop = np.cumsum(length)
            start = stop - length - (np.cumsum(total) - total)[row]
            view = memoryview(ids.tobytes())
            crc = [zlib.crc32(view[4 * (b - k): 4 * b]) for b, k in zip(stop.tolist(), length.tolist())]
            columns = [part.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length),
                       pa.array(crc, pa.int64()), pa.array(total[row])]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                cuts = pa.array(np.concatenate([[0], stop]), pa.int32())
                columns.append(pa.ListArray.from_arrays(cuts, pa.array(ids.view(np.int32))))
                names.append("ids")
            return pa.RecordBatch.from_arrays(columns, names)

        return one

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = map_text(narrow, "text", make, schema + (", ids array<int>" if with_ids else ""), SLICE_BYTES)
    return pieces.select("*", F.monotonically_increasing_id().alias("sequence_id"),
                         F.lit(0).cast("long").alias("offset"), F.col("length").alias("bucket"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Packed sequences as Parquet, one folder for each length, so a reader takes batches of
    equal length without padding."""
    packed.write.mode("errorifexists").partitionBy("bucket").parquet(path)
