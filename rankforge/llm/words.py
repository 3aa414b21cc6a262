"""Words and word shingles as 64-bit hashes, computed on the bytes of an Arrow column.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, with A-Z lower-cased: the
pattern ``[^\\x20\\x09-\\x0D]+`` on UTF-8 text. Everything is vectorised over a slice of
documents; a text is always read whole.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = U(0x9E3779B97F4A7C15)
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], U)
#: Bytes of a word beyond which it is digested on its own; bytes worked on at a time.
LONG = 1024
WINDOW = 1 << 21


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser, another one for each seed."""
    with np.errstate(over="ignore"):
        z = x + U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> U(30))) * U(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> U(27))) * U(0x94D049BB133111EB)
        return z ^ (z >> U(31))


def spans(low: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans of ``low``, which has 8 bytes to spare at its end. Eight
    bytes at a time; a span of over ``LONG`` bytes is digested on its own."""
    eight = np.ndarray(len(low) - 7, "<u8", low, strides=(1,))
    out = length.astype(U)
    todo, at, left = np.flatnonzero(length <= LONG), starts, length
    if len(todo) < len(starts):
        for i in np.flatnonzero(length > LONG):
            piece = low[starts[i]: starts[i] + length[i]].tobytes()
            out[i] = U(int.from_bytes(blake2b(piece, digest_size=8).digest(), "little"))
        at, left = starts[todo], length[todo]
    with np.errstate(over="ignore"):
        while len(todo):
            word = eight[at] & _MASK[np.minimum(left, 8)]
            out[todo] = (out[todo] ^ word) * _ODD
            out[todo] ^= out[todo] >> U(29)
            more = left > 8
            if not more.any():
                break
            todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return mix(out)


def _window_words(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start byte) of the words of one window; ``cuts``: document starts within."""
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[cuts] = inside[cuts]
    last = inside
    last[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(first)
    low = np.zeros(len(raw) + 8, np.uint8)
    low[:len(raw)] = _LOWER[raw]
    return spans(low, starts, np.flatnonzero(last) + 1 - starts), starts


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, word bounds of each document, start bytes). Document ``d`` has the words
    ``bounds[d]:bounds[d + 1]``. Works window by window, cut where no word is split."""
    hashes, starts, a = [], [], 0
    end = int(offsets[-1])
    while a < end:
        b, reach = end, WINDOW
        while a + reach < end:
            free = np.flatnonzero(_SPACE[raw[a + 1: a + reach]])
            doc = offsets[np.searchsorted(offsets, a + reach, side="right") - 1]
            b = max(int(doc), a + 1 + int(free[-1]) if len(free) else 0)
            if b > a:
                break
            b, reach = end, 2 * reach
        lo, hi = np.searchsorted(offsets, [a, b])
        inner = np.unique(offsets[lo:hi]) - a
        h, s = _window_words(raw[a:b], inner[inner < b - a])
        hashes.append(h)
        starts.append(s + a)
        a = b
    if not hashes:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
    starts = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(starts, offsets), starts


def document_of(bounds: np.ndarray) -> np.ndarray:
    """The document index of every element."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, bounds): every run of ``width`` words of a document; a document with
    fewer words has its whole sequence as one shingle, one without words none."""
    count = np.diff(bounds)
    n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    out_bounds = np.concatenate([[0], np.cumsum(n)])
    first = np.repeat(bounds[:-1], n) + np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1], n)
    take = np.repeat(np.minimum(count, width), n)
    out = np.zeros(len(first), U)
    with np.errstate(over="ignore"):
        for k in range(width):
            on = take > k
            if on.all():
                out = mix(out * U(0xD6E8FEB86659FD93) + hashes[first + k], k + 1)
            else:
                i = np.flatnonzero(on)
                out[i] = mix(out[i] * U(0xD6E8FEB86659FD93) + hashes[first[i] + k], k + 1)
    return out, out_bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct values in ascending order, and their bounds."""
    parts = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    n = np.array([len(p) for p in parts], np.int64)
    flat = np.concatenate(parts) if parts else values[:0]
    return flat, np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
