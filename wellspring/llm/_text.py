"""Vectorised text helpers over Arrow batches.

A batch of texts is one contiguous UTF-8 byte buffer with row offsets, so
words, hashes and counts are computed with a few numpy passes over the whole
batch instead of a Python step per word. A word is a maximal run of bytes
other than space and the five ASCII controls 0x09-0x0D, which is the pattern
``[^\\x20\\x09-\\x0D]+`` on UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_TAIL_MASK = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], dtype=U64)
_M1, _M2 = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)
_LONG_WORD = 64


def byte_rows(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string/binary column and its row offsets (n + 1); null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    col = col.cast(pa.large_binary())
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]] if data is not None and offs[-1] > offs[0] \
        else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def find_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the word offsets of the rows (n + 1)."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # a row boundary lies before this byte
    edge[offs] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> U64(32)
    h *= _M2
    h ^= h >> U64(29)
    return h


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte span: multiply-mix over 8-byte blocks, all
    spans at once; spans over 64 bytes are hashed one by one."""
    lens = ends - starts
    with np.errstate(over="ignore"):
        h = lens.astype(U64) * _M1 + U64(seed)
        if len(starts) == 0:
            return h
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        blocks = np.ndarray(len(data), dtype="<u8", buffer=padded, strides=(1,))
        active, k = np.flatnonzero((lens > 0) & (lens <= _LONG_WORD)), 0
        while len(active):
            left = lens[active] - k
            part = blocks[starts[active] + k] & _TAIL_MASK[np.minimum(left, 8)]
            h[active] = _mix((h[active] ^ part) * _M1)
            active, k = active[left > 8], k + 8
        for i in np.flatnonzero(lens > _LONG_WORD):
            h[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes(), seed)
        return _mix(h)


def window_hashes(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash (mod 2**64, odd ``base``) of every run of ``width`` word
    hashes; runs that cross rows are left to the caller to ignore."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        out, power = np.zeros(n, U64), U64(1)
        done, size, block = 0, 1, words.copy()  # doubling: block[i] covers `size` words from i
        bits = width
        step = U64(base)
        while bits:
            if bits & 1:
                out += block[done:done + n] * power
                power = power * step
                done += size
            bits >>= 1
            if bits:
                block = block[:-size] + block[size:] * step
                step = step * step
                size *= 2
        return _mix(out)


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """The row index of every item, from item offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def gather_runs(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """``concatenate([values[s:s + n] for s, n in zip(starts, lens)])`` without a loop."""
    total = int(lens.sum())
    if total == 0:
        return values[:0]
    ends = np.cumsum(lens)
    return values[np.arange(total) - np.repeat(ends - lens - starts, lens)]


def regroup(batches: Iterable[pa.RecordBatch], text: str, max_bytes: int = 8 << 20,
            max_rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``max_bytes`` of text (or one row) and ``max_rows`` rows."""
    held, size, rows = [], 0, 0
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        lens = np.asarray(pc.binary_length(col).fill_null(0).cast(pa.int64()))
        start, total = 0, np.cumsum(lens)
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = int(np.searchsorted(total, before + max_bytes - size, side="right"))
            stop = min(stop, start + max_rows - rows)
            if stop <= start and held:
                yield _joined(held)
                held, size, rows = [], 0, 0
                continue
            stop = max(stop, start + 1)
            held.append(batch.slice(start, stop - start))
            size += int(total[stop - 1] - before)
            rows += stop - start
            start = stop
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.concat_batches(held)
