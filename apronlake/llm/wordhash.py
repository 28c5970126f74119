"""Word spans and word hashes of many texts at once, in numpy.

All functions work on the UTF-8 bytes of an Arrow string column, so a task never
loops over words in Python. ``ASCII_SPACE`` words are ``[^\\x20\\x09-\\x0D]+``;
``ALNUM`` words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)

ASCII_SPACE = np.ones(256, dtype=bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift rounds)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def chunks_of(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Spans cut into pieces of eight bytes: (first byte, bytes, place in the span) of each, and each span's first piece."""
    n = (end - start + 7) >> 3
    first = np.cumsum(n) - n
    place = np.arange(int(n.sum())) - np.repeat(first, n)
    at = np.repeat(start, n) + 8 * place
    return at, np.minimum(np.repeat(end, n) - at, 8), place, first


def eight_bytes(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ``size`` (1 to 8) bytes from each place of ``data``, as one number."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    every = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    return every[at] & (_U(0xFFFFFFFFFFFFFFFF) >> (_U(64) - _U(8) * size.astype(np.uint64)))


@dataclass
class Words:
    """Words of the documents of one slice, in order.

    ``start`` and ``end`` are byte positions in ``data``; words of document d
    are ``ptr[d]`` to ``ptr[d + 1]``; ``doc`` is the document of each word.
    """

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    ptr: np.ndarray
    doc: np.ndarray

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hash of each word's bytes: a sum of mixed pieces of eight bytes."""
        at, size, place, first = chunks_of(self.start, self.end)
        h = (self.end - self.start).astype(np.uint64) * _U(0xD6E8FEB86659FD93) + _U(seed)
        if len(at):
            piece = mix(eight_bytes(self.data, at, size) ^ ((place.astype(np.uint64) + _U(1 + (seed & 0xFF))) * _BASE))
            has = self.end > self.start
            h[has] += np.add.reduceat(piece, first[has])
        return mix(h)


_LIBC = ctypes.CDLL(None)


def release() -> None:
    """Give freed memory back: workers live on through stages that need none of it."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of slices of about ``limit`` bytes; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b
    release()


def find_words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = ASCII_SPACE, lower: bool = False) -> Words:
    """Maximal runs of bytes that ``kind`` allows; none crosses a document's border."""
    if lower:
        data = LOWER[data]
    inside = kind[data]
    n = len(data)
    starts = inside.copy()
    ends = inside.copy()
    if n:
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        borders = offsets[1:-1]
        borders = borders[(borders > 0) & (borders < n)]
        starts[borders] = inside[borders]
        ends[borders - 1] = inside[borders - 1]
    start = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    ptr = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(ptr))
    return Words(data, offsets, start, end, ptr, doc)


def grams(words: Words, h: np.ndarray, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document, first word) of each run of ``n`` consecutive words of one document.

    With ``short`` a document of fewer words, but not none, has one run of all its words.
    """
    m = len(h)
    total = max(m - n + 1, 0)
    g = np.zeros(total, dtype=np.uint64)
    for i in range(n):
        g *= _BASE
        g += h[i : i + total]
    first = np.arange(total)
    same = words.doc[:total] == words.doc[n - 1 : n - 1 + total]
    g, first = mix(g[same]), first[same]
    doc = words.doc[first]
    if short:
        sizes = np.diff(words.ptr)
        few = np.flatnonzero((sizes > 0) & (sizes < n))
        if len(few):
            extra = np.zeros(len(few), dtype=np.uint64)
            for i in range(n - 1):
                has = sizes[few] > i
                extra[has] = extra[has] * _BASE + h[words.ptr[few[has]] + i]
            g = np.concatenate([g, mix(extra ^ _U(0x5851F42D4C957F2D))])
            doc = np.concatenate([doc, few])
            first = np.concatenate([first, words.ptr[few]])
            order = np.argsort(doc, kind="stable")
            g, doc, first = g[order], doc[order], first[order]
    return g, doc, first
