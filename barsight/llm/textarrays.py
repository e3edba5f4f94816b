"""Texts of an Arrow batch as numpy arrays: words, word hashes, shingles.

Everything works on UTF-8 bytes of many texts at once; no Python object is
made per word.  Hashes are 64-bit, equal for equal words wherever they stand."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_SEG = 1 << 18
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift-multiply)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    """n 64-bit constants derived from a seed."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U) + U(seed) * U(1_000_003)) * U(0x9E3779B97F4A7C15))


_K, _KINV = 0x9E3779B97F4A7C15 | 1, pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)
_BYTE = seeds(256, 17)
_POW = np.concatenate([[U(1)], np.cumprod(np.full(_SEG - 1, U(_K)))])
_INV = np.concatenate([[U(1)], np.cumprod(np.full(_SEG - 1, U(_KINV)))])
_STEP = seeds(64, 29) | U(1)

_low = np.arange(256, dtype=np.uint8)
_low[65:91] += 32
LOWER = _low
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_alnum = np.zeros(256, bool)
_alnum[0x30:0x3A] = _alnum[0x41:0x5B] = _alnum[0x61:0x7B] = _alnum[0x80:] = True
PUNCT = ~_alnum


def give_back() -> None:
    """Return freed memory to the system: an executor's Python workers are reused
    by later stages, and what they keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):           # another C library
    _TRIM = None


def text_chunks(column, limit: int = CHUNK_BYTES):
    """(first row, end row, bytes, offsets) of consecutive rows of a string
    column, about ``limit`` bytes each; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi
    if len(data) > 1 << 18:
        give_back()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """h with h[j] - h[i] = sum of code(byte) * K**position over [i, j)."""
    h = np.zeros(len(data) + 1, U)
    step, scale = pow(_K, _SEG, 1 << 64), 1
    for a in range(0, len(data), _SEG):
        part = data[a:a + _SEG]
        h[a + 1:a + 1 + len(part)] = _BYTE[part] * _POW[:len(part)] * U(scale)
        scale = scale * step % (1 << 64)
    return np.cumsum(h, out=h)


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes in [start, end), the same wherever they stand."""
    shift = _INV[start & (_SEG - 1)]
    seg = start >> 18
    if len(h) > _SEG:
        back = np.array([pow(_KINV, _SEG * i, 1 << 64) for i in range(len(h) // _SEG + 1)], U)
        shift = shift * back[seg]
    return mix((h[end] - h[start]) * shift + (end - start).astype(U))


def find_words(data: np.ndarray, offs: np.ndarray, gap: np.ndarray = SPACE):
    """(start, end, text index) of the maximal runs of bytes not in ``gap``."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    on = ~gap[data]
    first = np.zeros(n + 1, bool)
    first[offs] = True
    begins = on.copy()
    begins[1:] &= ~on[:-1] | first[1:n]
    ends = on.copy()
    ends[:-1] &= ~on[1:] | first[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def word_hashes(data: np.ndarray, offs: np.ndarray, gap: np.ndarray = SPACE):
    """(hash, start, end, text index) of the words, A-Z in lower case."""
    start, end, text = find_words(data, offs, gap)
    return span_hash(prefix_hash(LOWER[data]), start, end), start, end, text


def shingles(words: np.ndarray, text: np.ndarray, k: int = 5):
    """(hash, first word, text index): runs of k words inside a text; a text of
    1 to k-1 words has its whole sequence as its only one."""
    n = len(words)
    if not n:
        return words, np.zeros(0, np.int64), text
    m = max(0, n - k + 1)
    out = np.zeros(m, U)
    for j in range(k):
        out += words[j:j + m] * _STEP[j]
    full = text[:m] == text[k - 1:k - 1 + m] if m else np.zeros(0, bool)
    at = np.flatnonzero(full)
    hashes, where = mix(out[at]), text[at]
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    size = np.diff(np.r_[first, n])
    few = np.flatnonzero(size < k)
    if len(few):
        extra = np.zeros(len(few), U)
        for j in range(k - 1):
            has = size[few] > j
            extra[has] += words[first[few[has]] + j] * _STEP[j]
        hashes = np.r_[hashes, mix(extra + size[few].astype(U))]
        at, where = np.r_[at, first[few]], np.r_[where, text[first[few]]]
        order = np.argsort(where, kind="stable")
        hashes, at, where = hashes[order], at[order], where[order]
    return hashes, at, where


def list_column(values: np.ndarray, counts: np.ndarray, kind=None) -> pa.Array:
    """A list array of consecutive runs of ``values``."""
    offs = np.r_[0, np.cumsum(counts)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values, kind))


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for each range, one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - size), size)
