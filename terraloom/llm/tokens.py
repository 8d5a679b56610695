"""Vectorised access to texts in Arrow batches: raw UTF-8 buffers, words and their 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
SLICE = 1 << 20

_bytes = np.arange(256)
LOWER = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)
IS_WORD = ~((_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D)))
_rng = np.random.default_rng(20240501)
_BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_pow: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(1 << 16, 1 << (n - 1).bit_length())
    if size not in _pow:
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INV, np.uint64)
        up[0] = down[0] = 1
        _pow[size] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _pow[size]


def text_slices(texts: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of about ``limit`` bytes; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        o = offsets[i : j + 1]
        yield i, raw[o[0] : o[-1]], o - o[0]
        i = j


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of all texts; no word crosses a text's end."""
    w = IS_WORD[buf]
    if not len(w):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(w) + 1, bool)
    edge[offsets] = True
    start, end = w.copy(), w.copy()
    start[1:] &= ~w[:-1] | edge[1:-1]
    end[:-1] &= ~w[1:] | edge[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 18) -> np.ndarray:
    """64-bit hashes of the words with A-Z lower-cased; equal words have equal hashes at any place."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, at + block, "right")))
        s, e = starts[i:j] - at, ends[i:j] - at
        n = int(e[-1])
        up, down = _powers(n + 1)
        c = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[LOWER[buf[at : at + n]]] * up[:n], out=c[1:])
        out[i:j] = mix64((c[e] - c[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the first word of each text, and the number of words at the end."""
    return np.searchsorted(starts, offsets)


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``bounds`` (empty runs give 0)."""
    c = np.zeros(len(values) + 1, np.result_type(values, np.int64) if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=c[1:])
    return c[bounds[1:]] - c[bounds[:-1]]
