"""Vectorised word kernels shared by the text operators.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, which on valid
UTF-8 is the pattern ``[^\\x20\\x09-\\x0D]+``. All functions work on whole Arrow
string columns at once: the concatenated bytes are hashed with prefix sums modulo
2**64, so there is no Python loop over words or documents.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_GRAM = U64(0xD6E8FEB86659FD93)
_GRAM2 = U64(0xA0761D6478BD642F)
#: Bytes hashed at once; bounds the scratch memory of one slice.
SLICE_BYTES = 1 << 20
#: Bytes of text of which operators take the words apart at once; scratch memory is some thirty times that.
STEP_BYTES = 2 << 20

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

#: Everything in ASCII but letters and digits: for words without punctuation.
PUNCTUATION = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])

_powers: dict[tuple[int, bool], np.ndarray] = {}


def released(work):
    """work(batches) for mapInArrow; at its end the worker, which waits for other tasks, gives free memory back to the system."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # not every C library has it
                pass

    return run


def _power_table(base: np.uint64, n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, or those of its inverse; cached, grown by doubling."""
    key = (int(base), inverse)
    table = _powers.get(key)
    if table is None or len(table) < n:
        step = pow(int(base), -1, 1 << 64) if inverse else int(base)
        size = 1 << max(10, (n - 1).bit_length())
        table = np.ones(size, dtype=U64)
        filled = 1
        while filled < size:
            factor = U64(pow(step, filled, 1 << 64))
            table[filled : 2 * filled] = table[:filled] * factor
            filled *= 2
        _powers[key] = table
    return table[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Words:
    """Word boundaries and hashes of a column of texts.

    data: all bytes; start, end: byte range of each word; first: index of each
    document's first word (one more entry than documents); hash: 64-bit word hashes.
    """

    def __init__(self, texts: pa.Array | pa.ChunkedArray, lower: bool = False, hashes: bool = True, separator: np.ndarray = _SEPARATOR, prefixes: tuple[int, ...] = ()):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
        texts = texts.cast(pa.large_string())
        n = len(texts)
        if n:
            _, offsets, data = texts.buffers()
            offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1]
            raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
            raw = raw[offsets[0] : offsets[-1]]
            offsets = offsets - offsets[0]
            if texts.null_count:  # null is like no text, whatever bytes lie below it
                gone = ~np.asarray(texts.is_valid()) & (np.diff(offsets) > 0)
                if gone.any():
                    return self.__init__(texts.fill_null(""), lower, hashes, separator, prefixes)
        else:
            offsets, raw = np.zeros(1, np.int64), np.zeros(0, np.uint8)
        self.n_docs, self.data, self.offsets = n, raw, offsets
        inside = ~separator[raw]
        before = np.zeros(len(raw), dtype=bool)
        before[1:] = inside[:-1]
        cuts = offsets[:-1][np.diff(offsets) > 0]
        before[cuts] = False  # a word ends where its document ends
        self.start = np.flatnonzero(inside & ~before)
        after = np.zeros(len(raw), dtype=bool)
        after[:-1] = inside[1:]
        after[cuts[cuts > 0] - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets).astype(np.int64)
        #: for each length in bytes, the hash of each word's beginning (a shorter word's is that of the word)
        self.prefix = {k: np.empty(len(self.start), dtype=U64) for k in prefixes}
        self.hash = self._hashes(lower) if hashes else None

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def _hashes(self, lower: bool) -> np.ndarray:
        out = np.empty(len(self.start), dtype=U64)
        lo = 0
        while lo < len(out):
            hi = max(lo + 1, int(np.searchsorted(self.start, self.start[lo] + SLICE_BYTES)))
            at, to = int(self.start[lo]), int(self.end[hi - 1])
            raw = self.data[at:to]
            values = (_LOWER[raw] if lower else raw).astype(U64) + U64(1)
            values *= _power_table(_BASE, to - at)
            total = np.zeros(to - at + 1, dtype=U64)
            np.cumsum(values, out=total[1:])
            s, e = self.start[lo:hi] - at, self.end[lo:hi] - at
            back = _power_table(_BASE, to - at, True)[s]
            out[lo:hi] = (total[e] - total[s]) * back
            for k, prefix in self.prefix.items():
                prefix[lo:hi] = mix64((total[np.minimum(e, s + k)] - total[s]) * back)
            lo = hi
        return mix64(out)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def gram_hashes(words: np.ndarray, k: int, second: bool = False) -> np.ndarray:
    """Hash of every k consecutive entries (also across documents; see gram_starts)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    base = _GRAM2 if second else _GRAM
    total = np.zeros(len(words) + 1, dtype=U64)
    np.cumsum(words * _power_table(base, len(words)), out=total[1:])
    return mix64((total[k:] - total[:-k]) * _power_table(base, n, True))


def gram_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Mask over gram_hashes(): true where the k words lie in one document."""
    n = max(0, int(first[-1]) - k + 1)
    room = np.zeros(n + 1, dtype=np.int32)
    counts = np.diff(first)
    full = counts >= k
    np.add.at(room, np.minimum(first[:-1][full], n), 1)
    np.add.at(room, np.minimum(first[1:][full] - k + 1, n), -1)
    return np.cumsum(room[:n]) > 0


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive entries."""
    if len(x) < w:
        return x[:0]
    span, out = 1, x
    while 2 * span <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    if span < w:
        out = np.minimum(out[: len(x) - w + 1], out[w - span : w - span + len(x) - w + 1])
    return out
