"""Tokenizing by distinct units: a batch's texts are cut where no token can
reach across, equal units are encoded once, and the ids are put together again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wellspring.llm._text import U64, byte_rows, gather_runs, hash_spans

# Units of each of the two generations that a Python worker keeps. An entry takes about 100 bytes, with its ids.
CACHE_UNITS = 300_000
LONGEST_KEPT = 64  # bytes of a unit; longer ones seldom come again
_SEEDS = (0x5EED, 0xC0FFEE)
LONGEST_IDS = 64  # ids of a unit, so that what is kept is bounded in bytes: 300 bytes an entry at most


def unit_codes(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """For the units between ``cuts`` (ascending, from 0 to the end), each one's
    code among the distinct units, and these as a binary array."""
    offsets = pa.py_buffer(cuts.astype(np.int64).tobytes())
    units = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(data)])
    found = units.dictionary_encode()
    return np.asarray(found.indices), found.dictionary


class _Generation:
    """Units by 128 bits of hash, with their ids, in numpy arrays: an open-addressing table of entries."""

    def __init__(self, most: int):
        self.most, self.n = most, 0
        bits = max(4, int(np.ceil(np.log2(2 * most + 1))))
        self.shift, self.mask = U64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        self.keys = np.zeros((2, most), U64)
        self.start, self.length = np.zeros(most, np.int64), np.zeros(most, np.int64)
        self.flat = np.zeros(0, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key (a column of two hashes), -1 if it isn't here."""
        out = np.full(keys.shape[1], -1, np.int64)
        open_ = np.arange(keys.shape[1])
        slot = (keys[0] >> self.shift).astype(np.int64)
        while len(open_):
            entry = self.slots[slot[open_]]
            there = entry >= 0
            open_, entry = open_[there], entry[there]
            hit = (self.keys[0, entry] == keys[0, open_]) & (self.keys[1, entry] == keys[1, open_])
            out[open_[hit]] = entry[hit]
            open_ = open_[~hit]
            slot[open_] = (slot[open_] + 1) & self.mask
        return out

    def add(self, keys: np.ndarray, flat: np.ndarray, lens: np.ndarray) -> None:
        """New entries (different keys that aren't here, room for them given)."""
        entry = np.arange(self.n, self.n + len(lens))
        self.keys[:, entry] = keys
        self.start[entry] = len(self.flat) + np.cumsum(lens) - lens
        self.length[entry] = lens
        self.flat = np.concatenate([self.flat, flat])
        self.n += len(lens)
        slot = (keys[0] >> self.shift).astype(np.int64)
        left = np.arange(len(lens))
        while len(left):
            free = left[self.slots[slot[left]] < 0]
            self.slots[slot[free]] = entry[free]  # of several that want a slot, one gets it
            left = left[self.slots[slot[left]] != entry[left]]
            slot[left] = (slot[left] + 1) & self.mask


class UnitCache:
    """Ids of units, remembered in a Python worker in bounded memory. When the young generation is full it becomes
    the old one; what is asked for again moves up, so frequent units stay. Units of more than ``LONGEST_KEPT`` bytes
    or ``LONGEST_IDS`` ids are never kept, so text without spaces passes through. ``encode`` gives the flat ids of a
    list of units and how many each has."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = CACHE_UNITS):
        self.encode, self.most = encode, most
        self.young, self.old = _Generation(most), _Generation(1)

    def ids(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids of all (different) units, with each unit's start and length in them."""
        data, offs = byte_rows(units)
        keys = np.stack([hash_spans(data, offs[:-1], offs[1:], seed) for seed in _SEEDS])
        starts, lens = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        new, parts, size = np.arange(len(units)), [], 0
        for kept in (self.young, self.old):
            entry = kept.find(keys[:, new])
            hit = entry >= 0
            at, entry = new[hit], entry[hit]
            starts[at], lens[at] = kept.start[entry] + size, kept.length[entry]
            parts.append(kept.flat)
            size += len(kept.flat)
            new = new[~hit]
            if kept is self.old:
                again = at
        flat, sizes = self.encode(units.take(pa.array(new)).to_pylist())
        starts[new], lens[new] = size + np.cumsum(sizes) - sizes, sizes
        flat = np.concatenate([*parts, flat])
        short = new[(np.diff(offs)[new] <= LONGEST_KEPT) & (lens[new] <= LONGEST_IDS)]
        self._keep(keys, np.concatenate([again, short]), flat, starts, lens)
        return flat, starts, lens

    def _keep(self, keys, which, flat, starts, lens) -> None:
        while len(which):
            if self.young.n == self.most:
                self.old, self.young = self.young, _Generation(self.most)
            part, which = np.split(which, [self.most - self.young.n])
            self.young.add(keys[:, part], gather_runs(flat, starts[part], lens[part]), lens[part])


def put_together(codes: np.ndarray, flat: np.ndarray, starts: np.ndarray, lens: np.ndarray,
                 rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all units in order, and the id offsets of the rows, whose unit offsets are ``rows``."""
    sizes = lens[codes]
    ids = gather_runs(flat, starts[codes], sizes)
    total = np.concatenate([[0], np.cumsum(sizes)])
    return ids, total[rows]


def list_column(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32)))


def by_items(batches: Iterable[pa.RecordBatch], column: int, most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose list column has at most ``most`` items (or one row)."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.list_value_length(batch.column(column)).fill_null(0), dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, before + most, side="right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop
