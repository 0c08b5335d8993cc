"""Vectorised word and hash primitives over Arrow string buffers.

A *word* is a maximal run of bytes other than ASCII white space, so every
position is a byte offset into UTF-8 text and no text is ever decoded or cut
short. Null texts count as empty. Work is sliced by bytes, never by dropping
rows; a single text longer than a slice forms a slice of its own, of which words
are made block by block.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 500_000
#: Bytes that are looked at together in making words; a longer text takes no more memory but for its words.
BLOCK_BYTES = 1_000_000

_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_WBASE = 0xD1342543DE82EF95 | 1
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _pow(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of base and of its inverse modulo 2**64, at least n of each."""
    got = _powers.get(base)
    if got is None or len(got[0]) < n:
        size = max(n, SLICE_BYTES // 4)
        up = np.full(size, base, dtype=np.uint64)
        down = np.full(size, pow(base, -1, 2**64), dtype=np.uint64)
        up[0] = down[0] = 1
        got = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= 2 * SLICE_BYTES:
            _powers[base] = got
    return got


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets of texts in them; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    if offs is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0] : o[-1]], o - o[0]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives what was freed back to the system, which workers kept for later tasks wouldn't."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of the batch with about so many bytes of the column each; releases memory at the end."""
    n = batch.num_rows
    if not n:
        return
    _, offsets = flat(batch.column(column))
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(n, max(to, at + 1))
        yield batch.slice(at, to - at)
        at = to
    release()


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool) -> np.ndarray:
    """Hashes of words. Only a word of its own may be longer than BLOCK_BYTES, and is hashed piece by piece."""
    if len(data) > BLOCK_BYTES:
        total, power = 0, 1
        step = pow(_BASE, BLOCK_BYTES, 2**64)
        for lo in range(0, len(data), BLOCK_BYTES):
            total += power * int(_sums(data[lo : lo + BLOCK_BYTES], fold)[-1])
            power = power * step % 2**64
        return mix(np.array([total % 2**64], np.uint64))
    sums = _sums(data, fold)
    return mix((sums[end] - sums[start]) * _pow(_BASE, len(data) + 1)[1][start])


def _sums(data: np.ndarray, fold: bool) -> np.ndarray:
    """Sums of the bytes up to each place, as a polynomial."""
    if fold:  # ASCII case only
        data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _pow(_BASE, len(data) + 1)[0][: len(data)], out=out[1:])
    return out


class Words:
    """Words of a run of texts: byte starts and ends, text index, 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold: bool = False, white: np.ndarray = WHITE):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1
        kind = np.int32 if len(data) < 2**31 else np.int64
        starts, ends = [np.zeros(0, kind)], [np.zeros(0, kind)]
        inner = np.unique(offsets)  # a word ends where its text does
        for lo in range(0, len(data), BLOCK_BYTES):
            hi = min(lo + BLOCK_BYTES, len(data))
            solid = np.zeros(hi - lo + 2, dtype=bool)
            a, b = max(lo - 1, 0), min(hi + 1, len(data))
            solid[a - lo + 1 : b - lo + 1] = ~white[data[a:b]]
            cut = np.zeros(hi - lo + 1, dtype=bool)
            cut[inner[np.searchsorted(inner, lo) : np.searchsorted(inner, hi, side="right")] - lo] = True
            starts.append((np.flatnonzero(solid[1:-1] & (~solid[:-2] | cut[:-1])) + lo).astype(kind))
            ends.append((np.flatnonzero(solid[1:-1] & (~solid[2:] | cut[1:])) + lo + 1).astype(kind))
        self.start, self.end = np.concatenate(starts), np.concatenate(ends)
        #: First word of each text, n + 1 values.
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(self.n), np.diff(self.first))
        self.hash = np.empty(len(self.start), np.uint64)
        i = 0
        while i < len(self.start):
            j = max(i + 1, int(np.searchsorted(self.end, self.start[i] + BLOCK_BYTES, side="right")))
            at = int(self.start[i])
            self.hash[i:j] = _hashes(data[at : int(self.end[j - 1])], self.start[i:j] - at, self.end[i:j] - at, fold)
            i = j

    @classmethod
    def of(cls, texts: pa.Array, fold: bool = False) -> Words:
        return cls(*flat(texts), fold=fold)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def sums(self) -> np.ndarray:
        up, _ = _pow(_WBASE, len(self.hash) + 1)
        out = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(self.hash * up[: len(self.hash)], out=out[1:])
        return out

    def windows(self, at: np.ndarray, length, sums: np.ndarray) -> np.ndarray:
        """Hashes of the windows of so many words that start at these words."""
        _, down = _pow(_WBASE, len(self.hash) + 1)
        return mix((sums[at + length] - sums[at]) * down[at])

    def fits(self, length: int) -> np.ndarray:
        """Words at which a window of this length starts and ends in one text."""
        if len(self.hash) < length:
            return np.zeros(0, np.int64)
        last = self.first[1:] - length
        at = np.arange(len(self.hash) - length + 1)
        return at[at <= last[self.doc[: len(at)]]]


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order of text, and n + 1 offsets. A shorter text is one shingle."""
    counts = words.counts
    each = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    offsets = np.concatenate(([0], np.cumsum(each)))
    doc = np.repeat(np.arange(words.n), each)
    at = words.first[doc] + np.arange(offsets[-1]) - offsets[doc]
    return words.windows(at, np.minimum(size, counts[doc]), words.sums()), offsets


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
