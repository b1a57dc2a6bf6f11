"""Elias-Fano coding of monotone integer sequences, held in one memory-mapped file."""

from __future__ import annotations

import mmap
import tempfile

import numpy as np


class Levels:
    """Arrays put together in an unnamed temporary file and read through one memory map.

    The file has no name in any folder, so it goes with the process, however that ends.
    """

    def __init__(self):
        self._parts: list[tuple[int, int, np.dtype]] = []
        self._file = tempfile.TemporaryFile()
        self._map: mmap.mmap | None = None

    def add(self, values: np.ndarray) -> int:
        at = self._file.tell()
        self._file.write(np.ascontiguousarray(values).tobytes())
        self._file.write(b"\0" * (-self._file.tell() % 8))
        self._parts.append((at, len(values), values.dtype))
        return len(self._parts) - 1

    def seal(self) -> None:
        self._file.write(b"\0" * 8)
        self._file.flush()
        self._map = mmap.mmap(self._file.fileno(), 0, access=mmap.ACCESS_READ)

    def array(self, part: int) -> np.ndarray:
        at, n, dtype = self._parts[part]
        return np.frombuffer(self._map, dtype=dtype, count=n, offset=at)

    def nbytes(self) -> int:
        return sum(n * dtype.itemsize for _, n, dtype in self._parts)


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary with a directory of ones before every block.

    Everything is read from the mapped file; no level is unpacked.
    """

    BLOCK = 8  # 64-bit words of the unary part between two directory entries
    QUERIES = 1 << 17  # looked up at a time, which bounds the memory of a search

    def __init__(self, levels: Levels, values: np.ndarray):
        values = values.astype(np.uint64)
        n = len(values)
        self.n = n
        top = int(values[-1]) if n else 0
        self.bits = max(0, (top // max(n, 1)).bit_length() - 1) if n else 0
        bits = np.uint64(self.bits)
        self.top = top >> self.bits
        span = 64 * self.BLOCK
        unary = np.zeros(-(-(self.top + n + 1) // span) * span, dtype=bool)
        unary[(values >> bits).astype(np.int64) + np.arange(n)] = True
        low = values & ((np.uint64(1) << bits) - np.uint64(1))
        self._levels = levels
        self._high = levels.add(np.packbits(unary, bitorder="little").view(np.uint64))
        self._low = levels.add(_pack(low, self.bits))
        self._directory = levels.add(np.concatenate([[0], np.cumsum(unary.reshape(-1, span).sum(axis=1))[:-1]]).astype(np.int64))

    def _select(self, index: np.ndarray, ones: bool) -> np.ndarray:
        """Positions of the ones (or zeros) numbered ``index`` in the unary part."""
        words, before = self._levels.array(self._high), self._levels.array(self._directory)
        if not ones:
            before = np.arange(len(before)) * (64 * self.BLOCK) - before
        block = np.searchsorted(before, index, side="right") - 1
        rest, word = index - before[block], block * self.BLOCK
        live = np.arange(len(index))
        for _ in range(self.BLOCK - 1):
            x = words[word[live]]
            here = np.bitwise_count(x if ones else ~x).astype(np.int64)
            past = rest[live] >= here
            live, here = live[past], here[past]
            rest[live] -= here
            word[live] += 1
        x = words[word] if ones else ~words[word]
        at = word * 64
        for width in (32, 16, 8, 4, 2, 1):
            here = np.bitwise_count(x & np.uint64((1 << width) - 1)).astype(np.int64)
            past = rest >= here
            rest -= np.where(past, here, 0)
            at += np.where(past, width, 0)
            x = np.where(past, x >> np.uint64(width), x)
        return at

    def _low_bits(self, index: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(index), dtype=np.uint64)
        words = self._levels.array(self._low)
        at = index.astype(np.uint64) * np.uint64(self.bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        value = words[word] >> shift
        over = shift + np.uint64(self.bits) > np.uint64(64)
        value[over] |= words[word[over] + 1] << (np.uint64(64) - shift[over])
        return value & ((np.uint64(1) << np.uint64(self.bits)) - np.uint64(1))

    def access(self, index: np.ndarray) -> np.ndarray:
        index = index.astype(np.int64)
        high = (self._select(index, True) - index).astype(np.uint64)
        return (high << np.uint64(self.bits)) | self._low_bits(index)

    def find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First index whose entry is at least ``value`` (their number if there is none), and whether it is equal."""
        place, equal = np.empty(len(value), np.int64), np.empty(len(value), bool)
        for at in range(0, len(value), self.QUERIES):
            part = slice(at, at + self.QUERIES)
            place[part], equal[part] = self._find(value[part].astype(np.uint64))
        return place, equal

    def _find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place, equal = np.full(len(value), self.n, np.int64), np.zeros(len(value), bool)
        inside = np.flatnonzero(value >> np.uint64(self.bits) <= np.uint64(self.top)) if self.n else np.zeros(0, np.int64)
        high = (value[inside] >> np.uint64(self.bits)).astype(np.int64)
        low = value[inside] & ((np.uint64(1) << np.uint64(self.bits)) - np.uint64(1))
        # The entries with these high bits stand between two zeros of the unary part.
        lo = np.where(high > 0, self._select(np.maximum(high - 1, 0), False) + 1 - high, 0)
        stop = self._select(high, False) - high
        hi = stop.copy()
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            less = self._low_bits(mid) < low[live]
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
            live = live[lo[live] < hi[live]]
        place[inside] = lo
        here = np.flatnonzero(lo < stop)
        equal[inside[here]] = self._low_bits(lo[here]) == low[here]
        return place, equal

    def search(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """First index in ``[lo, hi)`` whose entry is at least ``value`` (``hi`` if there is none), for many queries at once."""
        return np.minimum(np.maximum(self.find(value)[0], lo), hi)


def _pack(low: np.ndarray, bits: int) -> np.ndarray:
    if not bits or not len(low):
        return np.zeros(2, dtype=np.uint64)
    out = np.zeros((len(low) * bits + 63) // 64 + 2, dtype=np.uint64)
    at = np.arange(len(low), dtype=np.uint64) * np.uint64(bits)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    np.bitwise_or.at(out, word, low << shift)
    over = shift + np.uint64(bits) > np.uint64(64)
    np.bitwise_or.at(out, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
    return out
