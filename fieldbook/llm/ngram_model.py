"""Operator 2: language model scores from Elias-Fano n-gram tries.

Model.  Three words with interpolated absolute discounting:

    p(w | u v) = max(c(u v w) - D, 0) / c(u v) + D * n(u v) / c(u v) * p(w | v)
    p(w | v)   = max(c(v w) - D, 0) / c(v) + D * n(v) / c(v) * q(w)
    q(w)       = (c(w) + 0.1) / (N + 0.1 * (V + 1))

with n(...) the different words after a context; an unseen context leaves its level out.  A text
begins with two begin marks and ends with the end token.  Every count covers all training rows
and every word has its own count at every level, whatever their number.

Execution.  One pass counts words.  Every position goes, packed, to the shard of its middle word
v, which so holds the contexts v and u v and all that follows them.  There are as many shards as
``SHARD_TOKENS`` goes into all tokens, so a task does not grow with the corpus.  What is more
frequent than a shard holds is dealt over many: the positions of a hot word by the word before
it, those of a hot pair u v by the word after it, those of a hot triple by their place in the
corpus.  The counts that a shard then cannot see itself come from aggregates: c, n of hot
contexts and c of hot triples, of their words and of their pairs v w are broadcast (at most all tokens / ``SHARD_TOKENS`` of each);
the other c(v w) of hot v and c(w) are joined, range by range of keys, to the words that a shard asks for.  The ``COMMON`` most frequent words are
broadcast to save their join; the result does not depend on that number.

A chunk of rows sends its ids, its word counts and the unigram sums of common words along once; a cell for a shard names common
words by their place among them and other words by their hash.  A shard builds its trie in a memory-mapped file: sorted contexts, monotone pointers, successors
relative to their context in Elias-Fano code, a third level whose words are their rank among the successors of the
shorter context, probabilities quantised to a byte.  Positions are looked up by successor search and
come back as sums per document.

Edge cases.  A null or blank text has the end token alone.  A null doc_id counts as
training.  Repeated rows count and are scored one by one.  Without training rows the model
knows no word.  A very long text is one piece while it is read, and is dealt over the shards like any other.  An
empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.elias_fano import EliasFano, Levels
from fieldbook.llm.storage import Scratch
from fieldbook.llm.words import blocks, mix

HELD_OUT = "pmod(crc32(cast(doc_id as string)), 10) = 0"
DISCOUNT = 0.75
SHARD_TOKENS = 1 << 20
COMMON = 1 << 17
CHUNK_TOKENS = 1 << 20
QUANTUM = 0.04  # log10 units between two stored probabilities: a byte reaches down to 10**-10.2
STEP = QUANTUM / 256  # log10 units between two sums that a shard sends back
SMALL = 512  # planes of fewer bytes are compressed together
BEGIN, END = np.uint64(1), np.uint64(2)  # marks outside the texts
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_ASKED = "range bigint, data binary"
_ANSWER = "shard int, data binary"
_CELL = "shard int, chunk bigint, ids boolean, data binary"
_PART = "chunk bigint, ids boolean, data binary"
_SUMS = "doc_id bigint, held boolean, words bigint, known bigint, base double, score double"
_COUNT = "kind int, owner bigint, key bigint, n bigint, tokens bigint"


class Hot(NamedTuple):
    """Contexts or triples that are dealt over shards: sorted keys, training counts, different words after each."""

    key: np.ndarray
    count: np.ndarray
    follow: np.ndarray

    def has(self, key: np.ndarray) -> np.ndarray:
        return _among(key, self.key)

    def override(self, key: np.ndarray, count: np.ndarray, follow: np.ndarray | None = None) -> None:
        if not len(self.key):
            return
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        mine = self.key[at] == key
        count[mine] = self.count[at[mine]]
        if follow is not None:
            follow[mine] = self.follow[at[mine]]


def _hot(key=(), count=(), follow=()) -> Hot:
    key = np.asarray(key, dtype=np.int64).view(np.uint64)
    order = np.argsort(key)
    return Hot(key[order], np.asarray(count, dtype=np.float64)[order], np.asarray(follow, dtype=np.float64)[order])


class Lower(NamedTuple):
    """What every shard knows: the totals, the common words, and what is dealt over shards."""

    total: int
    distinct: int
    shards: int
    common: np.ndarray  # sorted hashes, the end token among them
    common_count: np.ndarray
    by_count: np.ndarray  # places of the common words, the most frequent first
    word: Hot
    pair: Hot
    triple: Hot
    after: Hot  # frequent pairs of a hot word and the word after it

    def log_base(self, count: np.ndarray) -> np.ndarray:
        return _log_base(count, self.total, self.distinct)


def _log_base(count: np.ndarray, total: int, distinct: int) -> np.ndarray:
    return np.log10((count + 0.1) / (total + 0.1 * (distinct + 1)))


def _among(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of ``words`` are among sorted ``keys``."""
    if not len(keys):
        return np.zeros(len(words), bool)
    return keys[np.minimum(np.searchsorted(keys, words), len(keys) - 1)] == words


def _look_up(words: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values of ``words`` by sorted ``keys``, 0 for those that are not there."""
    if not len(keys):
        return np.zeros(len(words))
    at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
    return np.where(keys[at] == words, values[at], 0).astype(np.float64)


def gram(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Key of a pair, by order."""
    return mix(a * _GRAM + mix(b + np.uint64(1)))


def _number(value: int) -> bytes:
    """A count in as many bytes as it needs, seven bits in each."""
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def _squeezed(raw: bytes) -> tuple[bytes, bool]:
    """``raw``, compressed if that makes it shorter."""
    data = pa.compress(raw, codec="zstd", asbytes=True) if len(raw) > 32 else raw
    return (data, True) if len(data) < len(raw) else (raw, False)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays, their types and lengths in one value.

    Integers go byte by byte, as their high bytes are alike.  What is short is compressed together, or a small cell would be
    mostly headers.
    """
    head, body, small = [_number(len(arrays))], [], []
    for values in arrays:
        width = values.dtype.itemsize
        planes = values.view(np.uint8).reshape(len(values), width).T if values.dtype.kind == "u" else [values.view(np.uint8)]
        head += [values.dtype.kind.encode(), _number(width), _number(len(values))]
        if values.nbytes // len(planes) < SMALL:
            small += [plane.tobytes() for plane in planes]
            continue
        for plane in planes:
            data, shorter = _squeezed(plane.tobytes())
            head.append(_number(len(data) << 1 | shorter))
            body.append(data)
    data, shorter = _squeezed(b"".join(small))
    return b"".join([*head, _number(len(data) << 1 | shorter), *body, data])


def _unpack(data: bytes) -> list[np.ndarray]:
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte, at = data[at], at + 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    kinds = []
    for _ in range(number()):
        kind, at = chr(data[at]), at + 1
        dtype, n = np.dtype(f"{kind}{number()}"), number()
        planes = dtype.itemsize if kind == "u" else 1
        size = n * dtype.itemsize // planes
        kinds.append((dtype, n, planes, size, None if size < SMALL else [number() for _ in range(planes)]))
    rest = number()

    def taken(length: int, size: int) -> bytes:
        nonlocal at
        raw, at = data[at: at + (length >> 1)], at + (length >> 1)
        return pa.decompress(raw, decompressed_size=size, codec="zstd", asbytes=True) if length & 1 else raw

    large = [b"".join(taken(length, size) for length in lengths or ()) for _, _, _, size, lengths in kinds]
    small, out, used = taken(rest, sum(planes * size for _, _, planes, size, lengths in kinds if lengths is None)), [], 0
    for (dtype, n, planes, size, lengths), raw in zip(kinds, large, strict=True):
        if lengths is None:
            raw, used = small[used: used + planes * size], used + planes * size
        flat = np.frombuffer(raw, np.uint8)
        out.append((np.ascontiguousarray(flat.reshape(planes, n).T) if planes > 1 else flat).reshape(-1).view(dtype))
    return out


def _narrow(values: np.ndarray) -> np.ndarray:
    bits = int(values.max(initial=0)).bit_length()
    return values.astype(np.uint8 if bits <= 8 else np.uint16 if bits <= 16 else np.uint32 if bits <= 32 else np.uint64)


def _gaps(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Differences of values that grow from each of ``begins`` on; there the value itself."""
    out = np.diff(values, prepend=0)
    out[begins] = values[begins]
    return out


def _from_gaps(gaps: np.ndarray, runs: np.ndarray) -> np.ndarray:
    out, runs = np.cumsum(gaps, dtype=np.int64), runs.astype(np.int64)
    begins = np.cumsum(runs) - runs
    return out - np.repeat(out[begins] - gaps[begins], runs)


class Positions(NamedTuple):
    """Every position of some rows: the word, the two before it, the row, and whether the row is held out."""

    u: np.ndarray
    v: np.ndarray
    w: np.ndarray
    row: np.ndarray
    held: np.ndarray


def _positions(block, held: np.ndarray) -> Positions:
    n = np.diff(block.at)
    w = np.full(len(block.hash) + block.rows, END, np.uint64)
    starts, ends = block.at[:-1] + np.arange(block.rows), block.at[1:] + np.arange(block.rows)
    inner = np.ones(len(w), bool)
    inner[ends] = False
    w[inner] = block.hash
    row = np.repeat(np.arange(block.rows, dtype=np.int32), n + 1)
    v = np.concatenate([[BEGIN], w[:-1]])
    v[starts] = BEGIN
    u = np.concatenate([[BEGIN], v[:-1]])
    u[starts] = BEGIN
    return Positions(u, v, w, row, held[row])


def _shard_of(at: Positions, place: np.ndarray, lower: Lower) -> np.ndarray:
    """Shard of every position; ``place`` spreads the hot triples."""
    key = mix(at.v.copy())
    spread = np.flatnonzero(lower.word.has(at.v))
    if len(spread):
        pair = gram(at.u[spread], at.v[spread])
        key[spread] = pair
        hot = np.flatnonzero(lower.pair.has(pair))
        if len(hot):
            triple = gram(pair[hot], at.w[spread[hot]])
            key[spread[hot]] = triple
            again = np.flatnonzero(lower.triple.has(triple))
            key[spread[hot[again]]] = gram(triple[again], place[spread[hot[again]]].astype(np.uint64))
    return (key % np.uint64(lower.shards)).astype(np.int64)


def _summed(keys: tuple[np.ndarray, ...], trained: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct keys with their training positions and all positions."""
    order = np.lexsort(keys)
    sorted_ = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_])
    begin = np.flatnonzero(new)
    n = np.add.reduceat(trained[order].astype(np.int64), begin) if len(begin) else np.zeros(0, np.int64)
    return [k[begin] for k in sorted_], n, np.diff(np.append(begin, len(order)))


def _count(select: Callable):
    """Counts (kind, owner, key, n, tokens) of what ``select`` takes from the positions, summed per few million tokens."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush():
            kind, owner, key, trained = (np.concatenate([h[k] for h in held]) for k in range(4))
            (key, owner, kind), n, tokens = _summed((key, owner, kind), trained)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(kind.astype(np.int32)), pa.array(owner.view(np.int64)), pa.array(key.view(np.int64)), pa.array(n), pa.array(tokens)],
                names=["kind", "owner", "key", "n", "tokens"])
        for batch in batches:
            out = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for block in blocks(batch.column(0)):
                at = _positions(block, out[block.first: block.first + block.rows])
                for kind, owner, key, trained in select(at):
                    held.append((np.full(len(key), kind, np.int8), owner, key, trained))
                    size += len(key)
                if size >= 2 * CHUNK_TOKENS:
                    yield flush()
                    size = 0
        if held:
            yield flush()
    return count


def _words(at: Positions):
    yield 0, np.zeros(len(at.w), np.uint64), at.w, ~at.held


def _pairs_of(word: Hot):
    """Kind 1: pairs v w of hot v, owned by v.  Kind 2: pairs u v, which may be hot themselves."""
    def pairs(at: Positions):
        mine = np.flatnonzero(word.has(at.v))
        v, trained = at.v[mine], ~at.held[mine]
        yield 1, v, gram(v, at.w[mine]), trained
        yield 2, v, gram(at.u[mine], v), trained
    return pairs


def _triples_of(pair: Hot):
    def triples(at: Positions):
        key = gram(at.u, at.v)
        mine = np.flatnonzero(pair.has(key))
        yield 3, key[mine], gram(key[mine], at.w[mine]), ~at.held[mine]
    return triples


def _range_bits(lower: Lower) -> int:
    """Leading bits of a key that name its range: there is a range for every four shards, more or less."""
    return max(1, (lower.shards // 4).bit_length())


def _asked(lower: Lower):
    """Words, and pairs of hot words, whose counts a shard needs and cannot see: the keys of one range in order, and their shards."""
    bits = _range_bits(lower)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush():
            (shard, key), _, _ = _summed(tuple(np.concatenate([h[k] for h in held]) for k in (0, 1)), np.zeros(size, bool))
            held.clear()
            part = (key >> np.uint64(64 - bits)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
            data = [_pack(np.diff(key[a:b], prepend=np.uint64(0)), _narrow(shard[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]]), pa.array(data, pa.binary())], names=["range", "data"])
        for batch in batches:
            out = np.zeros(len(batch.column(0)), bool)
            for block in blocks(batch.column(0)):
                at = _positions(block, out[: block.rows])
                # The word and the pair of a hot triple are as frequent as it is, so they are never asked for and its place does not matter.
                shard = _shard_of(at, np.zeros(len(at.w), np.int64), lower)
                rare = np.flatnonzero(~_among(at.w, lower.common))
                spread = np.flatnonzero(lower.word.has(at.v))
                pair = gram(at.v[spread], at.w[spread])
                some = ~lower.after.has(pair)
                held += [(shard[rare], at.w[rare]), (shard[spread[some]], pair[some])]
                size += len(rare) + int(some.sum())
                if size >= 2 * CHUNK_TOKENS:
                    yield flush()
                    size = 0
        if held:
            yield flush()
    return asked


def _answer(asked: pa.Table, known: pa.Table) -> pa.Table:
    """What the shards ask of one range, each key once for a shard: its keys in order, and their counts."""
    asks = [_unpack(d) for d in asked.column("data").to_pylist()]
    key = np.concatenate([np.zeros(0, np.uint64), *(np.cumsum(gaps, dtype=np.uint64) for gaps, _ in asks)])
    shard = np.concatenate([np.zeros(0, np.int32), *(s.astype(np.int32) for _, s in asks)])
    (key, shard), _, _ = _summed((key, shard), np.zeros(len(key), bool))
    n = _look_up(key, *_sorted(known.column("key").to_numpy(), known.column("n").to_numpy())).astype(np.int64)
    cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
    data = [_pack(np.diff(key[a:b], prepend=np.uint64(0)), _narrow(n[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table([pa.array(shard[cuts[:-1]], pa.int32()), pa.array(data, pa.binary())], names=["shard", "data"])


def _cells(lower: Lower):
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, done = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40, 0
        held: list[tuple] = []
        size = rows = 0
        for batch in batches:
            for block in blocks(batch.column(1)):
                part = slice(block.first, block.first + block.rows)
                out = batch.column(2).to_numpy(zero_copy_only=False)[part].astype(bool)
                at = _positions(block, out)
                held.append((at._replace(row=at.row + np.int32(rows)), batch.column(0).slice(block.first, block.rows), out))
                size, rows = size + len(at.w), rows + block.rows
                if size >= CHUNK_TOKENS:
                    yield _chunk(held, base + done, lower)
                    done, size, rows = done + rows, 0, 0
        if held:
            yield _chunk(held, base + done, lower)
    return cells


def _chunk(held: list[tuple], chunk: int, lower: Lower) -> pa.RecordBatch:
    """One cell per shard, and one without positions that carries the ids of the chunk's rows and what is known of them here."""
    at = Positions(*(np.concatenate([h[0][k] for h in held]) for k in range(5)))
    ids = pa.concat_arrays([h[1] for h in held])
    absent = ids.is_null().to_numpy(zero_copy_only=False)
    out = np.concatenate([h[2] for h in held])
    held.clear()
    shard = _shard_of(at, at.row.astype(np.int64) + chunk, lower)
    row = at.row
    vocabulary, number = np.unique(np.concatenate([at.w, [BEGIN]]), return_inverse=True)
    del at
    # The base sums of common words are known here.
    count = _look_up(vocabulary, lower.common, lower.common_count)
    rank = np.empty(len(lower.common) + 1, np.int64)
    rank[lower.by_count], rank[-1] = np.arange(len(lower.common)) + 1, 0
    common = np.where(_among(vocabulary, lower.common), rank[np.searchsorted(lower.common, vocabulary)], 0)
    w = number[:-1]
    here, rows = (common > 0)[w], len(ids)
    log_q = lower.log_base(count)
    sums = (np.bincount(row, minlength=rows), np.bincount(row, weights=here & (count > 0)[w], minlength=rows).astype(np.int64),
            np.bincount(row, weights=np.where(here, log_q[w], 0), minlength=rows))
    # Common words come first, the most frequent before others, so most numbers are small; then the other words by their hash.
    order = np.argsort(np.where(common > 0, common, len(rank)), kind="stable")
    vocabulary, common, n_common = vocabulary[order], common[order], int((common > 0).sum())
    renumbered = np.empty(len(order), np.int64)
    renumbered[order] = np.arange(len(order))
    number = renumbered[number]
    w, begin = number[:-1], number[-1]
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    v = np.concatenate([[begin], w[:-1]])
    v[starts] = begin
    u = np.concatenate([[begin], v[:-1]])
    u[starts] = begin
    # Equal positions of a row are summed, so a word that fills a text is one entry.
    follows = (w.astype(np.uint64) << np.uint64(32)) | u.astype(np.uint64)
    middle = shard * len(vocabulary) + v
    del number, here, u, v, w, shard
    (row, follows, middle), _, times = _summed((row, follows, middle), np.zeros(len(row), bool))
    shard, v = np.divmod(middle, len(vocabulary))
    w, u = (follows >> np.uint64(32)).astype(np.int64), (follows & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cuts = np.searchsorted(shard, np.arange(lower.shards + 1))
    home = int(mix(np.array([chunk], dtype=np.uint64))[0] % np.uint64(lower.shards))
    cells = [(home, True, _pack(ids.fill_null(0).to_numpy(), out.astype(np.uint8) | (absent.astype(np.uint8) << 1), *sums))]
    local = np.zeros(len(vocabulary), np.int64)
    for s in np.flatnonzero(np.diff(cuts)):
        mine = slice(cuts[s], cuts[s + 1])
        begins = np.flatnonzero(np.concatenate([[True], v[mine][1:] != v[mine][:-1]]))
        first = v[mine][begins]
        docs, doc = _distinct(row[mine], rows)
        names, _ = _distinct(np.concatenate([first, w[mine], u[mine]]), len(vocabulary))
        local[names] = np.arange(len(names))
        runs = np.diff(np.append(begins, cuts[s + 1] - cuts[s]))
        rare = np.searchsorted(names, n_common)
        cells.append((int(s), False, _pack(
            _narrow(np.diff(docs, prepend=0)), out[docs].astype(np.uint8), _narrow(np.diff(common[names[:rare]], prepend=0)),
            np.diff(vocabulary[names[rare:]], prepend=np.uint64(0)),
            *map(_narrow, (np.diff(local[first], prepend=0), runs, _gaps(local[w[mine]], begins), local[u[mine]], doc, times[mine])))))
    shard, ids, data = zip(*cells, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array([chunk] * len(cells), pa.int64()), pa.array(ids), pa.array(data, pa.binary())],
                                      names=["shard", "chunk", "ids", "data"])


def _distinct(numbers: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers below ``n`` in order, and the place of each number among them."""
    if len(numbers) * 16 < n:
        return np.unique(numbers, return_inverse=True)
    there = np.zeros(n, bool)
    there[numbers] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[numbers]


class Counts(NamedTuple):
    """A level as counted: the number of the context and of the word of every entry (sorted), and how often."""

    context: np.ndarray
    word: np.ndarray
    n: np.ndarray


def _interpolate(n: np.ndarray, count: np.ndarray, back: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Discounted probability of entries seen ``n`` times in contexts seen ``count`` times, the level below mixed in."""
    return np.maximum(n - DISCOUNT, 0) / np.maximum(count, 1) + 10.0 ** back * lower


def _back(count: np.ndarray, follow: np.ndarray) -> np.ndarray:
    """log10 weight of the level below; 0 where the context was never seen."""
    return np.where(count > 0, np.log10(np.maximum(DISCOUNT * follow, 1e-9) / np.maximum(count, 1)), 0.0)


class Trie:
    """Contexts, their successors at two levels and the quantised log probabilities of one shard."""

    def __init__(self, contexts: np.ndarray, back: np.ndarray, two: Counts, p_two: np.ndarray, words: int,
                 longer: np.ndarray, back_longer: np.ndarray, three: Counts, p_three: np.ndarray, before: int):
        """``longer`` are context number * ``before`` + number of the word before it, sorted; ``three`` counts by their index."""
        levels = Levels()
        self.levels, self.words, self.before = levels, words, before
        self.context = EliasFano(levels, contexts)
        starts = np.searchsorted(two.context, np.arange(len(contexts) + 1))
        self.pointer = EliasFano(levels, starts)
        # Word numbers grow within a context; with the context's number in front they grow along the level.
        self.successor = EliasFano(levels, two.context.astype(np.uint64) * np.uint64(words) + two.word.astype(np.uint64))
        self._p_two = levels.add(_quantise(p_two))
        self.longer = EliasFano(levels, longer)
        # Every word of a triple follows the shorter context too: its rank there is its name.
        context = (longer // np.uint64(before)).astype(np.int64)[three.context]
        self.ranks = int(np.diff(starts).max(initial=0)) + 1
        place = np.searchsorted(two.context.astype(np.uint64) * np.uint64(words) + two.word.astype(np.uint64),
                                context.astype(np.uint64) * np.uint64(words) + three.word.astype(np.uint64))
        self.third = EliasFano(levels, three.context.astype(np.uint64) * np.uint64(self.ranks) + (place - starts[context]).astype(np.uint64))
        self._p_three = levels.add(_quantise(p_three))
        self._back, self._back_longer = levels.add(back), levels.add(back_longer)
        levels.seal()

    def log_probability(self, contexts: np.ndarray, pairs: tuple[np.ndarray, np.ndarray], longer: tuple[np.ndarray, np.ndarray],
                        triples: tuple[np.ndarray, np.ndarray], log_q: np.ndarray) -> np.ndarray:
        """log10 p(word | before context) of triples.

        Triples name their longer context and their pair, these the number of their context hash and that of their other word, so
        what many triples share is sought once.
        """
        at, known = self.context.find(contexts)
        context, word = pairs
        place, found = self.successor.find(at[context].astype(np.uint64) * np.uint64(self.words) + word.astype(np.uint64))
        found &= known[context]
        two = log_q[word] + np.where(known[context], self.levels.array(self._back)[np.minimum(at, self.context.n - 1)][context], 0.0)
        two[found] = self.levels.array(self._p_two)[place[found]] * -QUANTUM
        rank = np.zeros(len(place), np.int64)
        rank[found] = place[found] - self.pointer.access(at)[context[found]].astype(np.int64)
        context, before = longer
        long_at, seen = self.longer.find(at[context].astype(np.uint64) * np.uint64(self.before) + before.astype(np.uint64))
        seen &= known[context]
        back = np.zeros(len(seen))
        back[seen] = self.levels.array(self._back_longer)[long_at[seen]]
        stored, out = self.levels.array(self._p_three), np.empty(len(triples[0]))
        for start in range(0, len(out), EliasFano.QUERIES):
            of_longer, of_pair = (x[start: start + EliasFano.QUERIES] for x in triples)
            part = two[of_pair] + back[of_longer]
            ask = np.flatnonzero(seen[of_longer] & found[of_pair])
            third, there = self.third.find(long_at[of_longer[ask]].astype(np.uint64) * np.uint64(self.ranks)
                                           + rank[of_pair[ask]].astype(np.uint64))
            part[ask[there]] = stored[third[there]] * -QUANTUM
            out[start: start + len(part)] = part
        return out


def _quantise(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(p) / QUANTUM), 0, 255).astype(np.uint8)


def _score_shard(lower: Lower):
    def score(cells: pa.Table, asked: pa.Table) -> pa.Table:
        whole = cells.column("ids").to_numpy()
        passed = cells.filter(pa.array(whole)).select(["chunk", "ids", "data"])
        cells = cells.filter(pa.array(~whole))
        if not cells.num_rows:
            return passed

        # Numbers of a shard's words and rows fit four bytes; the arrays with an entry per position are kept few and narrow.
        columns = [list(c) for c in zip(*map(_unpack, cells.column("data").to_pylist()), strict=True)]
        gaps, flags, common, rare, first, runs, second, prior, doc, times = columns
        names = [np.concatenate([lower.common[lower.by_count[np.cumsum(c, dtype=np.int64) - 1]], np.cumsum(hashes, dtype=np.uint64)])
                 for c, hashes in zip(common, rare, strict=True)]
        first = [np.cumsum(x, dtype=np.int64) for x in first]
        second = [_from_gaps(x, n) for x, n in zip(second, runs, strict=True)]
        words, number = np.unique(np.concatenate(names), return_inverse=True)
        number = np.split(number.astype(np.int32), np.cumsum([len(x) for x in names])[:-1])
        first, second, prior = (np.concatenate([m[x] for m, x in zip(number, column, strict=True)]) for column in (first, second, prior))
        del names, number
        there, first = _distinct(first, len(words))
        contexts = words[there]
        context = np.repeat(first.astype(np.int32), np.concatenate(runs).astype(np.int64))
        doc_at = np.cumsum([0, *map(len, flags)])
        doc = np.concatenate([(s + d.astype(np.int64)).astype(np.int32) for s, d in zip(doc_at, doc, strict=False)])
        times = np.concatenate(times).astype(np.int64)
        trained = np.where(np.concatenate(flags)[doc] & 1, 0, times)
        n_docs, n_words = int(doc_at[-1]), np.uint64(len(words))

        answers = [_unpack(d) for d in asked.column("data").to_pylist()]
        keys = np.concatenate([np.zeros(0, np.uint64), *(np.cumsum(gaps, dtype=np.uint64) for gaps, _ in answers)])
        numbers = np.concatenate([np.zeros(0), *(n for _, n in answers)])
        keys, numbers = _sorted(keys, numbers)
        word_count = np.maximum(_look_up(words, lower.common, lower.common_count), _look_up(words, keys, numbers))
        log_q = lower.log_base(word_count)

        # The pairs v w, then the contexts u v, then the triples, all of them numbered in sorted order.
        two, two_of = _ranked(context, n_words, second)
        longer, longer_of = _ranked(context, n_words, prior)
        three, which = _ranked(longer_of, n_words, second)
        of_two, of_three = two_of[_first(which, len(three))], (three // n_words).astype(np.int32)
        count = np.bincount(context, weights=trained, minlength=len(contexts))
        two_n = np.bincount(two_of, weights=trained, minlength=len(two))
        longer_n = np.bincount(longer_of, weights=trained, minlength=len(longer))
        three_n = np.bincount(which, weights=trained, minlength=len(three))
        del trained
        del two_of, longer_of, context, prior
        three_word = (three % n_words).astype(np.int32)
        del three

        two_context, two_word = (two // n_words).astype(np.int64), (two % n_words).astype(np.int64)
        spread = lower.word.has(contexts)[two_context]
        pair = gram(contexts[two_context[spread]], words[two_word[spread]])
        two_n[spread] = np.maximum(_look_up(pair, keys, numbers), _look_up(pair, lower.after.key, lower.after.count))
        follow = np.bincount(two_context[two_n > 0], minlength=len(contexts)).astype(np.float64)
        lower.word.override(contexts, count, follow)
        longer_context, longer_word = (longer // n_words).astype(np.int64), (longer % n_words).astype(np.int64)
        longer_key = gram(words[longer_word], contexts[longer_context])
        lower.triple.override(gram(longer_key[of_three], words[three_word]), three_n)
        longer_follow = np.bincount(of_three[three_n > 0], minlength=len(longer)).astype(np.float64)
        lower.pair.override(longer_key, longer_n, longer_follow)

        back, back_longer = _back(count, follow), _back(longer_n, longer_follow)
        p_two = _interpolate(two_n, count[two_context], back[two_context], 10.0 ** log_q[two_word])
        p_three = _interpolate(three_n, longer_n[of_three], back_longer[of_three], p_two[of_two])
        seen2, seen3, seen_long = two_n > 0, three_n > 0, longer_n > 0
        new_number = np.cumsum(seen_long) - 1
        seen3 &= seen_long[of_three]
        trie = Trie(contexts, back, Counts(two_context[seen2], two_word[seen2], two_n[seen2]), p_two[seen2], len(words),
                    longer[seen_long], back_longer[seen_long],
                    Counts(new_number[of_three[seen3]], three_word[seen3].astype(np.int64), three_n[seen3]), p_three[seen3], len(words))
        log_p = trie.log_probability(contexts, (two_context, two_word), (longer_context, longer_word), (of_three, of_two), log_q)
        del two, longer, three_word, p_two, p_three, two_context, two_word
        value = np.rint(np.bincount(doc, weights=log_p[which] * times, minlength=n_docs) / -STEP).astype(np.int64)
        del which, log_p
        # The base sums of common words are known where the cell comes from.
        # For other words their counts go back, each once per row with how often it stands there: they are shorter than sums.
        rare_at = np.flatnonzero(~_among(words, lower.common)[second])
        of, which = np.unique((doc[rare_at].astype(np.uint64) << np.uint64(32)) | word_count[second[rare_at]].astype(np.uint64),
                              return_inverse=True)
        often = np.bincount(which, weights=times[rare_at], minlength=len(of)).astype(np.int64)
        of, count = (of >> np.uint64(32)).astype(np.int64), of & np.uint64(0xFFFFFFFF)
        cuts = np.searchsorted(of, doc_at)
        # A row goes back per cell, packed.
        data = []
        for gap, a, b, lo, hi in zip(gaps, doc_at[:-1], doc_at[1:], cuts[:-1], cuts[1:], strict=True):
            data.append(_pack(gap, *map(_narrow, (value[a:b], np.diff(of[lo:hi], prepend=a), count[lo:hi], often[lo:hi]))))
        scored = pa.table([cells.column("chunk"), cells.column("ids"), pa.array(data, pa.binary())], names=["chunk", "ids", "data"])
        return pa.concat_tables([passed, scored])
    return score


def _ranked(a: np.ndarray, n: np.uint64, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of two numbers, the second below ``n``, as ``a * n + b`` in order, and the number of each pair."""
    values, at = np.unique(a.astype(np.uint64) * n + b.astype(np.uint64), return_inverse=True)
    return values, at.astype(np.int32)


def _first(which: np.ndarray, n: int) -> np.ndarray:
    """A position of every number below ``n``."""
    out = np.zeros(n, np.int64)
    out[which] = np.arange(len(which))
    return out


def _merge_chunk(total: int, distinct: int):
    """Sums of the rows of one chunk (a bounded number of tokens) over all shards."""
    def merge(table: pa.Table) -> pa.Table:
        whole = table.column("ids").to_numpy()
        ids, flags, words, known, base = _unpack(table.column("data").filter(pa.array(whole))[0].as_py())
        score, rare = np.zeros(len(ids)), []
        for data in table.column("data").filter(pa.array(~whole)).to_pylist():
            gap, value, of, count, often = _unpack(data)
            docs = np.cumsum(gap, dtype=np.int64)
            score[docs] -= value * STEP
            rare.append((docs[np.cumsum(of, dtype=np.int64)], count.astype(np.int64), often.astype(np.int64)))
        if rare:
            doc, count, often = (np.concatenate(c) for c in zip(*rare, strict=True))
            known = known + np.bincount(doc, weights=often * (count > 0), minlength=len(ids)).astype(np.int64)
            base = base + np.bincount(doc, weights=often * _log_base(count, total, distinct), minlength=len(ids))
        return pa.table([pa.array(ids, mask=(flags & 2).astype(bool)), pa.array((flags & 1).astype(bool)),
                         pa.array(words), pa.array(known), pa.array(base), pa.array(score)],
                        names=["doc_id", "held", "words", "known", "base", "score"])
    return merge


def _columns(df: DataFrame, *types) -> list[np.ndarray]:
    table = df.toArrow()
    return [table.column(k).to_numpy().astype(t) for k, t in enumerate(types)]


def _counted(rows: DataFrame, select: Callable, scratch: Scratch, name: str) -> DataFrame:
    sums = rows.select("text", "held").mapInArrow(_count(select), _COUNT).groupBy("kind", "owner", "key")
    return scratch.store(sums.agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens")), name)


def fit_lower(rows: DataFrame, scratch: Scratch, shard_tokens: int, common: int = COMMON) -> tuple[Lower, DataFrame]:
    """What all shards share, and the counts (key, n) that they ask for, from all rows (doc_id, text, held)."""
    counts = _counted(rows, _words, scratch, "words")
    row = counts.agg(F.sum("n"), F.sum((F.col("n") > 0).cast("bigint")), F.sum("tokens")).first()
    total, distinct, tokens = (int(x or 0) for x in row)
    shards = max(2, -(-tokens // shard_tokens))
    many = counts.where(F.col("tokens") > shard_tokens)
    frequent = counts.orderBy(F.desc("tokens"), "key").limit(common).unionAll(many).select("key", "n").distinct()
    top, top_n = _sorted(*_columns(frequent, np.int64, np.float64))
    texts = rows.agg(F.count(F.lit(1)), F.sum((~F.col("held")).cast("bigint"))).first()
    key, n = _columns(many.where(F.col("key") != int(END)).select("key", "n"), np.int64, np.float64)
    if texts[0] > shard_tokens:
        key, n = np.append(key, np.int64(BEGIN)), np.append(n, float(texts[1]))
    word, pair, triple, after = _hot(key, n, np.zeros(len(n))), _hot(), _hot(), _hot()
    known = counts.select("key", "n")
    if len(key):
        pairs = _counted(rows, _pairs_of(word), scratch, "pairs")
        owner, m = _columns(pairs.where("kind = 1 and n > 0").groupBy("owner").count(), np.int64, np.float64)
        word = word._replace(follow=_look_up(word.key, *_sorted(owner, m)))
        known = known.unionAll(pairs.where("kind = 1").select("key", "n"))
        many = pairs.where(F.col("tokens") > shard_tokens)
        key, n = _columns(many.where("kind = 1").select("key", "n"), np.int64, np.float64)
        after = _hot(key, n, np.zeros(len(n)))
        key, n = _columns(many.where("kind = 2").select("key", "n"), np.int64, np.float64)
        if len(key):
            pair = _hot(key, n, np.zeros(len(n)))
            triples = _counted(rows, _triples_of(pair), scratch, "triples")
            owner, m = _columns(triples.where("n > 0").groupBy("owner").count(), np.int64, np.float64)
            pair = pair._replace(follow=_look_up(pair.key, *_sorted(owner, m)))
            key, n = _columns(triples.where(F.col("tokens") > shard_tokens).select("key", "n"), np.int64, np.float64)
            triple = _hot(key, n, np.zeros(len(n)))
    by_count = np.argsort(-top_n, kind="stable").astype(np.int32)
    return Lower(total, distinct, shards, top, top_n, by_count, word, pair, triple, after), known


def _sorted(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = key.view(np.uint64)
    order = np.argsort(key)
    return key[order], value[order]


def score_documents(docs: DataFrame, shard_tokens: int = SHARD_TOKENS, common: int = COMMON) -> DataFrame:
    """Scores of every document (doc_id, text) under the model of the rows that are not held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.
    """
    scratch = Scratch(docs.sparkSession, "ngram-model")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"),
                       F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held"))
    lower, known = fit_lower(rows, scratch, shard_tokens, common)
    of = F.shiftrightunsigned("key", 64 - _range_bits(lower)).alias("range")
    asked = (rows.select("text").mapInArrow(_asked(lower), _ASKED).groupBy("range")
             .cogroup(known.select(of, "key", "n").groupBy("range")).applyInArrow(_answer, _ANSWER))
    cells = rows.mapInArrow(_cells(lower), _CELL)
    parts = cells.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(_score_shard(lower), _PART)
    sums = parts.groupBy("chunk").applyInArrow(_merge_chunk(lower.total, lower.distinct), _SUMS)
    return sums.select("doc_id", F.col("held").alias("held_out"), F.col("words").alias("n_tokens"), F.col("known").alias("n_known"),
                       F.lit(lower.total).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score"), "score")
