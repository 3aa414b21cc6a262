"""Language identification with bit-sliced Bloom filters over character n-grams.

Each language has a Bloom filter of its letter trigrams (a word's edges count as a blank). The
filters lie bit-sliced in one table: slot s holds a word with bit l set if language l's filter
has bit s. Looking up an n-gram ANDs the words of its ``hashes`` slots and so returns the mask
of all languages that contain it. A text's mask bits are counted for each language, the count
is corrected by the language's false positive rate (its fill to the power ``hashes``), and
the language with the largest corrected share decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import cut, map_text
from .words import U, mix

UNKNOWN = "und"
#: Least slots of the table (8 bytes each and 64 languages), hash functions, and the false positive
#: rate that the table is sized for, by the language with the most n-grams (7 to 13 slots for each).
SLOT_BITS, HASHES, FALSE_RATE = 20, 3, 0.05
#: An n-gram belongs to a language if it occurs there this often at least, and at this share
#: of the rate that it has in the language where it is most frequent. A language with little
#: text has a lower floor: 1, and one more for every so many n-grams of it.
MIN_COUNT, MIN_SHARE = 3, 0.02
FLOOR_STEP = 20_000
SLICE_BYTES = 4 << 20

_TABLES: list[np.ndarray] = []


def _lower() -> np.ndarray:
    """Each code point's lower-case letter, 0 where it is no letter."""
    if not _TABLES:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if chr(c).isalpha():
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _TABLES.append(table)
    return _TABLES[0]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, bounds): one trigram for each letter, with its neighbours (0 for a non-letter);
    text ``d`` has ``codes[bounds[d]:bounds[d + 1]]``."""
    texts = [t or "" for t in texts]
    points = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    x = _lower()[points].astype(U)
    at = np.flatnonzero(x)
    codes = (x[at - 1] << U(42)) | (x[at] << U(21)) | x[at + 1] if len(at) else np.zeros(0, U)
    ends = np.cumsum([len(t) + 1 for t in texts]) + 1
    return codes, np.searchsorted(at, np.concatenate([[0], ends]))


def ngram_counts(docs: DataFrame) -> DataFrame:
    """``lang, code, n`` over all rows of ``docs`` (text, lang)."""

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            codes, bounds = trigrams(part.column("text").to_pylist())
            names = part.column("lang").dictionary_encode()
            lang = np.repeat(names.indices.to_numpy(), np.diff(bounds))
            out = []
            for k in range(len(names.dictionary)):
                code, n = np.unique(codes[lang == k], return_counts=True)
                out.append((np.full(len(code), k), code, n))
            which, code, n = (np.concatenate(x) for x in zip(*out))
            return pa.RecordBatch.from_arrays([names.dictionary.take(pa.array(which)),
                                               pa.array(code.view(np.int64)), pa.array(n)], ["lang", "code", "n"])
        return one

    return (map_text(docs, "text", make, "lang string, code long, n long", SLICE_BYTES)
            .groupBy("lang", "code").agg(F.sum("n").alias("n")))


@dataclass(frozen=True)
class Model:
    """``languages`` in order of their bits; ``table[plane, slot]``; ``false_rate`` of each."""

    languages: list[str]
    table: np.ndarray
    false_rate: np.ndarray

    def shares(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """(texts, languages): the share of a text's n-grams that are in each language's
        filter, corrected for false positives."""
        n = np.diff(bounds)
        out = np.zeros((len(n), len(self.languages)))
        some = np.flatnonzero(n)
        if not len(some):
            return out
        slots = _slots(codes, self.table.shape[1])
        for plane in range(len(self.table)):
            mask = self.table[plane][slots[0]]
            for s in slots[1:]:
                mask &= self.table[plane][s]
            for bit in range(min(64, len(self.languages) - 64 * plane)):
                hits = np.add.reduceat(((mask >> U(bit)) & U(1)).astype(np.int32), bounds[some])
                out[some, 64 * plane + bit] = hits / n[some]
        return np.clip((out - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9), 0, 1)


def table_size(ngrams: int) -> int:
    """Slots, a power of two, in which so many n-grams of a language have at most ``FALSE_RATE``."""
    fill = FALSE_RATE ** (1 / HASHES)
    want = int(HASHES * ngrams / -np.log1p(-fill)) + 1
    return 1 << max(SLOT_BITS, (want - 1).bit_length())


def _slots(codes: np.ndarray, size: int) -> list[np.ndarray]:
    """Double hashing: slot i is a + i * b."""
    h = mix(codes, 31)
    a, b = h & U((1 << SLOT_BITS) - 1), (h >> U(32)) | U(1)
    return [((a + U(i) * b) & U(size - 1)).astype(np.int64) for i in range(HASHES)]


def train(docs: DataFrame) -> Model:
    """Fit the filters on all rows of ``docs`` (text, lang) with a text and a language. What
    reaches the driver is the table itself: ``table_size`` of the n-grams of the language that has
    most. Repeated rows count as often as they occur."""
    counts = ngram_counts(docs.where("text IS NOT NULL AND lang IS NOT NULL"))
    totals = sorted(((r["n"], r["lang"]) for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()),
                    key=lambda x: (-x[0], x[1]))
    languages = [lang for _, lang in totals]
    if not languages:
        return Model([], np.zeros((0, 1 << SLOT_BITS), U), np.zeros(0))
    bit = F.create_map(*[F.lit(x) for k, (_, lang) in enumerate(totals) for x in (lang, k)])
    size = F.create_map(*[F.lit(x) for n, lang in totals for x in (lang, float(n))])
    floor = F.create_map(*[F.lit(x) for n, lang in totals for x in (lang, min(MIN_COUNT, 1 + n // FLOOR_STEP))])
    rates = counts.withColumns({"bit": F.element_at(bit, F.col("lang")), "rate": F.col("n") / F.element_at(size, F.col("lang"))})
    kept = (rates.withColumn("top", F.max("rate").over(Window.partitionBy("code")))
            .where((F.col("n") >= F.element_at(floor, F.col("lang"))) & (F.col("rate") >= MIN_SHARE * F.col("top"))).select("bit", "code"))
    kept = cut(kept)
    most = kept.groupBy("bit").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    size_ = table_size(most or 0)

    def spread(batches):
        for b in batches:
            slots = np.stack(_slots(b.column("code").to_numpy().view(U), size_))
            bits = np.tile(b.column("bit").to_numpy().astype(np.int64), HASHES)
            yield pa.RecordBatch.from_arrays([pa.array(slots.reshape(-1)), pa.array(bits // 64),
                                              pa.array(U(1) << (bits % 64).astype(U)).cast(pa.uint64())
                                              .view(pa.int64())], ["slot", "plane", "word"])

    found = (kept.mapInArrow(spread, "slot long, plane long, word long")
             .groupBy("plane", "slot").agg(F.bit_or("word").alias("word")).toArrow())
    table = np.zeros((-(-len(languages) // 64), size_), np.int64)
    table[found["plane"].to_numpy(), found["slot"].to_numpy()] = found["word"].to_numpy()
    table = table.view(U)
    fill = [float(((table[k // 64] >> U(k % 64)) & U(1)).mean()) for k in range(len(languages))]
    return Model(languages, table, np.array(fill) ** HASHES)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` in front of its columns named otherwise: the
    language of each whole text and its corrected share of n-grams. A text that is null or has
    no letter (or any text, when no language was learned) is ``und`` with score 0; ties go to
    the language with more training text, so a text none of whose n-grams is known gets that.
    Repeated rows and null ids are kept, each predicted alike; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model_ = shared.value

        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            codes, bounds = trigrams(part.column(text_col).to_pylist())
            share = model_.shares(codes, bounds)
            known = (np.diff(bounds) > 0) & (share.shape[1] > 0)
            best = share.argmax(axis=1) if share.shape[1] else np.zeros(len(share), np.int64)
            names = pa.array([UNKNOWN, *model_.languages]).take(pa.array(np.where(known, best + 1, 0)))
            score = np.where(known, share[np.arange(len(share)), best] if share.shape[1] else 0.0, 0.0)
            return pa.RecordBatch.from_arrays([*part.columns, names, pa.array(score)],
                                              [*part.schema.names, "lang_pred", "score"])
        return one

    rest = docs.drop("lang_pred", "score")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return map_text(rest, text_col, make, schema + ", lang_pred string, score double", SLICE_BYTES)
