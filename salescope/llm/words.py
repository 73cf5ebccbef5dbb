"""Words of whole texts as 64-bit hashes, taken straight from Arrow's byte buffers.

A word is a run of bytes other than space and \\x09-\\x0D.  Hashes are polynomials over a table of
random 64-bit values for bytes, finished by a bit mixer; they are the same on every machine.  Work
goes in blocks of about ``BLOCK`` bytes, so memory doesn't follow the size of a batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15


def released(run: Callable) -> Callable:
    """``run`` over a task's batches; at its end the worker, which Spark keeps for other tasks, gives free memory back."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def give_back() -> None:
    """Free memory of this worker goes back to the system."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it keeps what it has


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0], _powers[1]


def _hash_block(data: np.ndarray, firsts: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data`` and the places where they begin; a word also ends before each of ``firsts``."""
    n = len(data)
    space = _SPACE[data]
    after = np.empty(n + 1, dtype=bool)  # whether a word can begin here
    after[0] = after[n] = True
    after[1:n] = space[:-1]
    after[firsts] = True
    begin = np.flatnonzero(~space & after[:n])
    ends = after[1:].copy()
    ends[:-1] |= space[1:]
    end = np.flatnonzero(~space & ends) + 1
    up, down = _power_tables(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * up[:n], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64)), begin


def hash_words(data: np.ndarray, firsts: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """As ``_hash_block``, for data of any length: it is cut at white space or at ``firsts`` into blocks."""
    n, at, hashes, begins = len(data), 0, [], []
    while at < n:
        cut = min(n, at + BLOCK)
        if cut < n:
            ok = np.flatnonzero(_SPACE[data[at:cut]])
            first = firsts[np.searchsorted(firsts, at, "right") : np.searchsorted(firsts, cut, "right")]
            cuts = [at + int(ok[-1]) + 1] if len(ok) else []
            cuts += [int(first[-1])] if len(first) else []
            if cuts:
                cut = max(cuts)
            else:  # one word fills the block: go on to its end
                later = firsts[np.searchsorted(firsts, cut) :]
                stop = int(later[0]) if len(later) else n
                while cut < stop and not _SPACE[data[cut]]:
                    ahead = np.flatnonzero(_SPACE[data[cut : min(stop, cut + BLOCK)]])
                    cut = cut + int(ahead[0]) if len(ahead) else min(stop, cut + BLOCK)
        lo, hi = np.searchsorted(firsts, [at, cut])
        h, b = _hash_block(data[at:cut], firsts[lo:hi] - at, lower)
        hashes.append(h)
        begins.append(b + at)
        at = cut
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(begins)


def text_blocks(texts: pa.Array, size: int = 4 * BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``size`` bytes of text: first row, row after the last, bytes, offsets within them."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    n = len(texts)
    if not n:
        return
    off = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def word_blocks(texts: pa.Array, lower: bool = False, size: int = 4 * BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows: first row, row after the last, hashes of all their words, and where each row's words begin (one place more)."""
    for lo, hi, data, off in text_blocks(texts, size):
        firsts = np.unique(off[:-1][off[:-1] < len(data)])
        hashes, begin = hash_words(data, firsts, lower)
        yield lo, hi, hashes, np.searchsorted(begin, off)


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; none for shorter inputs."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[i : i + n]
    return mix(out)
