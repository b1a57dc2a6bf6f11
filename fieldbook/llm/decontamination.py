"""Operator 10: documents that carry benchmark passages, by latent semantic retrieval.

The benchmark is cut into passages of at most ``PASSAGE`` words, which overlap by three quarters in longer items: a run
of words that stands in a document fills most of one passage, wherever the cuts are.  Their TF-IDF matrix, with document
frequencies counted over the whole corpus, is reduced by a randomised SVD whose products
Spark sums over the passages; the driver keeps factors of a fixed size.  Every document is
read once more: windows of its words, as long as the passages they are compared with and one
step apart, are projected into the latent space, and the cosine with each passage gives the
candidates.  A short passage fills a window less, so its cosine has to reach what it would among foreign words.  A candidate counts if the longest common subsequence of words covers the passage,
or covers most of it and the passage's answer (its last sentence) stands there too.

Queries are handled in blocks of ``BLOCK`` passages, so what the tasks receive has a bound
however large the benchmark is; whole documents are searched, window by window.

Edge cases.  Null and blank texts, of documents or of the benchmark, match nothing; so do
items of fewer than ``MIN_WORDS`` words.  Very long documents are searched whole, window by window, very long items in all
their passages.  Null ids are carried as they are.  Repeated rows are
reported once per (doc_id, item_id).  Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.storage import Scratch
from fieldbook.llm.words import Block, blocks

PASSAGE = 64
OVERLAP = 16  # words between the begins of neighbouring passages, at most
BLOCK = 4096
MIN_WORDS = 5
STEP = 8  # words between windows
RANK = 256
EXTRA = 16
POWER = 2
COSINE = 0.45  # of what a passage itself reaches in the latent space
AMONG = 0.85  # of the cosine that a verbatim passage has with a window of otherwise foreign words
WEIGHT = 0.45  # share of a passage's own weight that a candidate must have along it
COVERED = 0.6
PARTLY = 0.45
ANSWER = 0.8
TEXT_BYTES = 1 << 19
_FACTOR_BLOCKS = 16
_MATCH = "doc_id bigint, item_id bigint, cosine double, common bigint, passage_words bigint, answer boolean"


class Passages(NamedTuple):
    """A block of benchmark passages, with the vocabulary that they use."""

    item: list  # item_id of each passage
    words: list[np.ndarray]  # hashes, in order
    answer: list[np.ndarray]
    vocabulary: np.ndarray  # sorted hashes


class Space(NamedTuple):
    """Latent space of a block: projected passages and the weights of their words."""

    passages: Passages
    project: np.ndarray  # (vocabulary, RANK): idf-weighted factors
    norm2: np.ndarray  # idf squared per word, the last for words outside the vocabulary
    share: float  # least part of a window's weight that known words must have for any candidate
    query: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # steps of a window -> passage numbers, unit vectors / cosine limit, least score


def _word_hashes(text: str) -> np.ndarray:
    block = next(blocks(pa.array([text or ""])), None)
    return block.hash if block else np.zeros(0, np.uint64)


def passages_of(items: list[tuple]) -> Passages:
    """Cut (item_id, text) rows into passages; the last sentence of an item is the answer of its last passage."""
    item, words, answer = [], [], []
    for item_id, text in items:
        own = _word_hashes(text)
        if len(own) < MIN_WORDS:
            continue
        n = 1 + max(0, -(-(len(own) - PASSAGE) // OVERLAP))
        last = _word_hashes(re.split(r"[.!?]\s+", text.strip())[-1])
        last = last if 3 <= len(last) < len(own) else own[-5:]
        for k in range(n):
            begin = (len(own) - PASSAGE) * k // (n - 1) if n > 1 else 0
            item.append(item_id)
            words.append(own[begin: begin + PASSAGE])
            answer.append(last if k == n - 1 else words[-1][-5:])
    vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
    return Passages(item, words, answer, vocabulary)


class _Lookup:
    """Positions of word hashes in a sorted vocabulary, by a small table of candidates first."""

    BITS = 18

    def __init__(self, vocabulary: np.ndarray):
        self.vocabulary = vocabulary
        self.maybe = np.zeros(1 << self.BITS, dtype=bool)
        self.maybe[(vocabulary & np.uint64((1 << self.BITS) - 1)).astype(np.int64)] = True

    def __call__(self, words: np.ndarray) -> np.ndarray:
        out = np.full(len(words), len(self.vocabulary), dtype=np.int64)
        some = np.flatnonzero(self.maybe[(words & np.uint64((1 << self.BITS) - 1)).astype(np.int64)])
        if len(some):
            at = np.minimum(np.searchsorted(self.vocabulary, words[some]), len(self.vocabulary) - 1)
            hit = self.vocabulary[at] == words[some]
            out[some[hit]] = at[hit]
        return out


def _document_counts(vocabulary: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, n, docs = _Lookup(vocabulary), np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            for block in blocks(batch.column(0)):
                word = find(block.hash)
                inside = word < len(vocabulary)
                seen = np.unique(block.row[inside] * len(vocabulary) + word[inside])
                n += np.bincount(seen % len(vocabulary), minlength=len(vocabulary))
                docs += block.rows
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(n)), -1], pa.int64()), pa.array([*n, docs], pa.int64())],
                                         names=["word", "n"])
    return count


def _weights(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, float]:
    """Inverse document frequencies of the vocabulary over all documents, and that of an unseen word."""
    table = (docs.select("text").mapInArrow(_document_counts(vocabulary), "word bigint, n bigint")
             .groupBy("word").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(len(vocabulary) + 1, np.float64)
    counts[table.column(0).to_numpy()] = table.column(1).to_numpy()
    total, n = counts[-1], counts[:-1]
    idf = np.log1p((total - n + 0.5) / (n + 0.5))
    return idf, float(min(np.log(2 * total + 2), 1.5 * np.sqrt(np.mean(idf ** 2))))


def _products(factor: np.ndarray):
    """Per partition of passages: the sum of a (a . factor) over its rows a, cut into blocks of words."""
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros_like(factor)
        for batch in batches:
            for at, weight in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, weight = np.array(at, np.int64), np.array(weight)
                out[at] += weight[:, None] * (weight @ factor[at])[None, :]
        parts = np.array_split(np.arange(len(out)), _FACTOR_BLOCKS)
        yield pa.RecordBatch.from_arrays([pa.array(range(_FACTOR_BLOCKS), pa.int32()),
                                          pa.array([out[p].tobytes() for p in parts], pa.binary())], names=["part", "sums"])
    return products


def _sum_parts(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.float64) for x in table.column("sums").to_pylist())
    return pa.table([table.column("part").slice(0, 1), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])


def latent_factors(rows: DataFrame, n_words: int, rank: int, seed: int = 11) -> np.ndarray:
    """Right singular vectors (n_words, rank) of the rows (at array<bigint>, weight array<double>), by randomised SVD."""
    wide = min(n_words, rank + EXTRA)
    factor = np.random.default_rng(seed).standard_normal((n_words, wide))

    def times(f: np.ndarray) -> np.ndarray:
        got = (rows.mapInArrow(_products(f), "part int, sums binary").groupBy("part")
               .applyInArrow(_sum_parts, "part int, sums binary").toArrow().sort_by("part"))
        flat = [np.frombuffer(x, np.float64) for x in got.column(1).to_pylist()]
        return np.concatenate(flat).reshape(-1, f.shape[1]) if flat else np.zeros_like(f)
    for _ in range(POWER):
        factor, _ = np.linalg.qr(times(factor))
    inner = factor.T @ times(factor)
    value, vector = np.linalg.eigh((inner + inner.T) / 2)
    return factor @ vector[:, np.argsort(-value)[:rank]]


def window_steps(words: int) -> int:
    """Steps of the windows for a passage; a short one lies in them whole, wherever it begins."""
    return -(-words // STEP) if words > 2 * STEP else -(-(words - 1) // STEP) + 1


def build_space(docs: DataFrame, passages: Passages, scratch: Scratch, rank: int = RANK) -> Space:
    idf, other = _weights(docs, passages.vocabulary)
    n = len(passages.vocabulary)
    tf = []
    for words in passages.words:
        at, count = np.unique(np.searchsorted(passages.vocabulary, words), return_counts=True)
        tf.append((at.tolist(), (count * idf[at]).tolist()))
    spark = docs.sparkSession
    rows = scratch.store(spark.createDataFrame(tf, "at array<bigint>, weight array<double>"), "passages")
    factors = latent_factors(rows, n, min(rank, n))
    project = (idf[:, None] * factors).astype(np.float32)
    query: dict[int, tuple[list, list, list]] = {}
    least = COSINE
    for k, (at, weight) in enumerate(tf):
        weight = np.array(weight)
        vector = weight @ factors[at]
        length = np.linalg.norm(vector)
        if length < 1e-9:
            continue
        steps = window_steps(len(passages.words[k]))
        own = float(weight @ weight)
        foreign = (steps * STEP - len(passages.words[k])) * other ** 2
        limit = min(COSINE, AMONG * np.sqrt(own / (own + foreign))) * length / np.sqrt(own)
        least = min(least, limit)
        numbers, vectors, scores = query.setdefault(steps, ([], [], []))
        numbers.append(k)
        vectors.append(vector / length / limit)
        scores.append(WEIGHT * length / limit)
    ready = {s: (np.array(a), np.array(v, np.float32).T.copy(), np.array(c, np.float32)) for s, (a, v, c) in query.items()}
    return Space(passages, project, np.append(idf ** 2, other ** 2).astype(np.float32), least ** 2, ready)


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, with a bit per word of ``a``."""
    place: dict[int, int] = {}
    for k, w in enumerate(a.tolist()):
        place[w] = place.get(w, 0) | 1 << k
    full = (1 << len(a)) - 1
    left = full
    for w in b.tolist():
        hit = left & place.get(w, 0)
        left = ((left + hit) | (left - hit)) & full
    return len(a) - left.bit_count()


def _confirm(passages: Passages, k: int, region: np.ndarray) -> tuple[bool, int, bool]:
    words, answer = passages.words[k], passages.answer[k]
    common = common_words(words, region)
    told = common_words(answer, region) >= ANSWER * len(answer)
    return common >= COVERED * len(words) or (told and common >= PARTLY * len(words)), common, told


def _matches(space: Space, find: _Lookup, block: Block) -> Iterator[tuple[int, int, float, int, bool]]:
    """(row, passage, cosine, common words, answer) of the confirmed passages in a block.

    A window's cosine with any passage is at most the root of the known words' part of its
    weight, so windows below that bound are left out before anything is projected.
    """
    word = find(block.hash)
    known = np.flatnonzero(word < len(space.passages.vocabulary))
    if not len(known) or not space.query:
        return
    steps = -(-np.diff(block.at) // STEP)
    gap = max(space.query) - 1
    place = np.concatenate([[0], np.cumsum(steps + (steps > 0) * gap)])  # of each row among the steps, with room behind it
    step = place[block.row] + (np.arange(len(word)) - block.at[block.row]) // STEP
    size = int(place[-1])
    weight = _step_sums(space.norm2[word], step, size)
    inside = _step_sums(space.norm2[word[known]], step[known], size)
    windows, norm, part, at = {}, weight.copy(), inside.copy(), 1
    used = np.zeros(size, dtype=bool)
    for length in sorted(space.query):
        for j in range(at, length):
            norm[:-j] += weight[j:]
            part[:-j] += inside[j:]
        at = length
        first = np.flatnonzero((part >= space.share * norm) & (part > 0))
        windows[length] = first, norm[first]
        for j in range(length):
            used[first + j] = True
    known = known[used[step[known]]]
    if not len(known):
        return
    vectors = _step_sums(space.project[word[known]], step[known], size)
    done: set[tuple[int, int]] = set()
    for length, (first, norm) in windows.items():
        numbers, unit, least = space.query[length]
        for lo in range(0, len(first), 4096):
            some = first[lo: lo + 4096]
            window = sum(vectors[some + j] for j in range(length))
            size2 = np.maximum(norm[lo: lo + 4096], np.einsum("ij,ij->i", window, window))
            score = window @ unit
            limit = np.sqrt(np.maximum(size2, 1e-9))[:, None]
            where, which = np.nonzero((score >= limit) & (score >= least))
            ratio = score[where, which] / limit[where, 0]
            for k in np.argsort(-ratio, kind="stable"):
                begin, passage = int(some[where[k]]), int(numbers[which[k]])
                row = int(np.searchsorted(place, begin, side="right")) - 1
                if (row, passage) in done:
                    continue
                start = block.at[row] + max(0, (begin - place[row] - 1) * STEP)
                stop = min(block.at[row + 1], block.at[row] + (begin - place[row] + length + 1) * STEP)
                good, common, told = _confirm(space.passages, passage, block.hash[start:stop])
                if good:
                    done.add((row, passage))
                    yield row, passage, float(ratio[k] * COSINE), common, told


def _step_sums(values: np.ndarray, step: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``values`` per step; ``step`` is in order."""
    out = np.zeros((size, *values.shape[1:]), np.float32)
    begins = np.flatnonzero(np.concatenate([[True], step[1:] != step[:-1]])) if len(step) else step
    if len(begins):
        out[step[begins]] = np.add.reduceat(values, begins, axis=0)
    return out


def _search(space: Space):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _Lookup(space.passages.vocabulary)
        for batch in batches:
            for block in blocks(batch.column(1), block_bytes=TEXT_BYTES):
                rows = list(_matches(space, find, block))
                if rows:
                    row, passage, cosine, common, told = zip(*rows, strict=True)
                    ids = batch.column(0).take(pa.array([block.first + r for r in row]))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([space.passages.item[p] for p in passage], pa.int64()), pa.array(cosine), pa.array(common, pa.int64()),
                         pa.array([len(space.passages.words[p]) for p in passage], pa.int64()), pa.array(told)],
                        names=["doc_id", "item_id", "cosine", "common", "passage_words", "answer"])
    return search


def _keep_clean(space: Space, text_at: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _Lookup(space.passages.vocabulary)
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for block in blocks(batch.column(text_at), block_bytes=TEXT_BYTES):
                for row, *_ in _matches(space, find, block):
                    clean[block.first + row] = False
            yield batch.filter(pa.array(clean))
    return keep


def _spaces(docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> Iterator[Space]:
    """One latent space per block of benchmark items; a block is a hash range of the items."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null")
    size = F.size(F.split("text", r"[\x20\x09-\x0D]+"))
    passages = items.agg(F.sum(F.floor(F.greatest(size - PASSAGE, F.lit(0)) / OVERLAP) + 2)).first()[0] or 0
    n = -(-passages // BLOCK)
    for k in range(n):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        found = passages_of(sorted(((r.item_id, r.text) for r in mine.toLocalIterator()), key=lambda r: (r[0] is None, r[0], r[1])))
        if found.words:
            yield build_space(docs, found, scratch)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark items found in documents: doc_id, item_id, cosine, common, passage_words, answer.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text.  A row is one item in one
    document, with its best passage.
    """
    scratch = Scratch(docs.sparkSession, "leaks")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], _MATCH)
    for space in _spaces(docs, benchmark, scratch):
        out = out.union(docs.mapInArrow(_search(space), _MATCH))
    best = F.max(F.struct(F.col("common") / F.col("passage_words"), "cosine", "common", "passage_words", "answer")).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.cosine", "b.common", "b.passage_words", "b.answer")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without benchmark passages, with all their columns."""
    scratch = Scratch(docs.sparkSession, "leaks")
    out = docs
    for space in _spaces(docs, benchmark, scratch):
        out = out.mapInArrow(_keep_clean(space, docs.columns.index("text")), docs.schema)
    return out
