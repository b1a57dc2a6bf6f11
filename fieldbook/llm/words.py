"""Vectorised word scanning over Arrow string columns (helper of the llm operators).

A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D``.  The scan works on
the UTF-8 bytes of whole texts, in blocks of about one megabyte, so that memory
does not depend on the batch.  Hashes are 64-bit values that depend on the bytes
of a word alone; equal words have equal hashes on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_AS_IS = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


class Block(NamedTuple):
    """Words of the rows ``first .. first + rows - 1`` of a column.

    ``row`` (relative to ``first``) and ``hash`` have one entry per word, ``at`` the
    words before each row (one entry more than rows); ``data`` are the scanned bytes
    and ``start``/``end`` the byte span of each word in them.
    """

    first: int
    rows: int
    row: np.ndarray
    hash: np.ndarray
    at: np.ndarray
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, offsets


def blocks(column: pa.Array, lower: bool = True, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Scan a string column in blocks of whole rows; a very long row is a block alone."""
    data, offsets = text_buffers(column)
    table = _LOWER if lower else _AS_IS
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + block_bytes, side="right")) - 1
        last = min(max(last, first + 1), n)
        part = table[data[offsets[first]: offsets[last]]]
        yield _scan(first, part, offsets[first: last + 1] - offsets[first])
        first = last


def _scan(first: int, data: np.ndarray, bounds: np.ndarray) -> Block:
    rows = len(bounds) - 1
    inside = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[bounds] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    row = np.searchsorted(bounds, start, side="right") - 1
    up, down = _POWERS.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    value = (sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)
    at = np.zeros(rows + 1, dtype=np.int64)
    np.cumsum(np.bincount(row, minlength=rows), out=at[1:])
    return Block(first, rows, row, mix(value), at, data, start, end)


def shingle_hashes(block: Block, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``width``-word shingle, and the shingles before each row.

    A row with fewer words gives its whole sequence as one shingle; a row without
    words gives none.
    """
    words, at = block.hash, block.at
    n = np.diff(at)
    parts = []
    if len(words) >= width:
        value = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for j in range(width):
            value = value * np.uint64(0xD6E8FEB86659FD93) + words[j: len(words) - width + 1 + j]
        whole = block.row[: len(value)] == block.row[width - 1:]
        parts.append((block.row[: len(value)][whole], mix(value[whole])))
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        value = n[short].astype(np.uint64)
        for j in range(width - 1):
            has = n[short] > j
            value[has] = value[has] * np.uint64(0xA24BAED4963EE407) + words[at[short[has]] + j]
        parts.append((short, mix(value)))
    counts = np.zeros(block.rows + 1, dtype=np.int64)
    if not parts:
        return np.zeros(0, np.uint64), counts
    rows = np.concatenate([p[0] for p in parts])
    values = np.concatenate([p[1] for p in parts])
    order = np.argsort(rows, kind="stable")
    np.cumsum(np.bincount(rows, minlength=block.rows), out=counts[1:])
    return values[order], counts
