"""Ranked lexical search by the Best Position Algorithm.

The documents are read once per block of items: their terms are counted, and the occurrences of the
items' terms are stored with each document.  After the corpus counts (documents, terms, documents per
term) are known, every task turns the documents it holds, chunk by chunk, into impact lists: one list
per term, a position for each document, the largest impact first.  An item is then answered chunk by
chunk: its lists are read in parallel from the top (sorted access); a document that is seen is looked up in
all other lists at once (direct access), and every list remembers the best position up to which all its
documents have been seen in either way.  The impacts at the best positions bound the score of
every unseen document; reading stops as soon as this bound lies strictly below the kth best
score so far, which also holds what earlier chunks of the task have found.

The best ten of a task go on, never its lists.  Items are held on the driver and broadcast in blocks
of at most ``ITEM_BYTES`` of distinct terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldbook.llm.storage import Scratch
from fieldbook.llm.words import mix, text_buffers

TOP = 10
ITEM_BYTES = 8 << 20      # bytes of terms in a block of items
CHUNK_DOCS = 1 << 16      # documents whose lists a task holds at once
CHUNK_POSTINGS = 1 << 21  # and their postings
TEXT_BYTES = 1 << 20      # text scanned at once
READ = 64                 # positions of a list in the first read; doubled with each further one

# Bytes of a term: digits, letters, and all bytes of characters outside ASCII.
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_B = np.uint64(0x9E3779B97F4A7C55)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Terms(NamedTuple):
    """Terms of a block of rows: row, byte span in ``data``, and a hash of the bytes."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    data: np.ndarray


def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of byte spans: a running sum of powers, brought back to the span's own start."""
    steps = np.full(len(data) + 1, _B, np.uint64)
    steps[0] = 1
    up = np.multiply.accumulate(steps)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    steps[1:] = pow(int(_B), -1, 1 << 64)
    down = np.multiply.accumulate(steps)
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def terms(column: pa.Array) -> Iterator[tuple[int, int, Terms]]:
    """(first row, rows, terms) of blocks of whole rows of a string column; null is empty."""
    data, offsets = text_buffers(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + TEXT_BYTES, side="right")) - 1
        last = min(max(last, first + 1), n)
        part, bounds = _LOWER[data[offsets[first]: offsets[last]]], offsets[first: last + 1] - offsets[first]
        inside = _TERM[part]
        cut = np.zeros(len(part) + 1, bool)
        cut[bounds] = True
        edge = np.zeros(len(part) + 1, bool)
        edge[1:-1] = inside[1:] != inside[:-1]
        start = np.flatnonzero(inside & (edge[:-1] | cut[:-1]))
        end = np.flatnonzero(inside & (edge[1:] | cut[1:])) + 1
        row = np.searchsorted(bounds, start, side="right") - 1
        yield first, last - first, Terms(row, start, end, _hash(part, start, end), part)
        first = last


class Lexicon:
    """Terms of a block of items, found by hash and then compared byte by byte."""

    def __init__(self, known: list[str]):
        self.words = sorted(known)
        raw = [w.encode() for w in self.words]
        data = np.frombuffer(b"".join(raw), np.uint8)
        self.end = np.cumsum([len(w) for w in raw]).astype(np.int64)
        self.start = np.concatenate([np.zeros(1, np.int64), self.end[:-1]]) if raw else self.end
        self.data = data
        value = _hash(data, self.start, self.end)
        self.order = np.argsort(value, kind="stable")
        self.hash = value[self.order]
        if len(np.unique(value)) < len(value):
            raise ValueError("two terms of the items share a hash")

    def find(self, found: Terms) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``found`` that are known terms, and the number of each term."""
        if not len(self.hash) or not len(found.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        spot = np.minimum(np.searchsorted(self.hash, found.hash), len(self.hash) - 1)
        at = np.flatnonzero(self.hash[spot] == found.hash)
        term = self.order[spot[at]]
        length = self.end[term] - self.start[term]
        same = found.end[at] - found.start[at] == length
        at, term, length = at[same], term[same], length[same]
        equal = np.ones(len(at), bool)
        left, j = np.arange(len(at)), 0
        while len(left):
            left = left[length[left] > j]
            equal[left] &= found.data[found.start[at[left]] + j] == self.data[self.start[term[left]] + j]
            j += 1
        return at[equal], term[equal]


def _count(lexicon):
    """(doc_id, n, terms, tf) of every row with a term; terms and tf name the items' terms only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Lexicon = lexicon.value
        size = len(known.words) + 1
        for batch in batches:
            ids = batch.column(0)
            for first, rows, found in terms(batch.column(1)):
                n = np.bincount(found.row, minlength=rows)
                at, term = known.find(found)
                key, tf = np.unique(found.row[at] * size + term, return_counts=True)
                row, term = key // size, key % size
                bounds = np.zeros(rows + 1, np.int64)
                np.cumsum(np.bincount(row, minlength=rows), out=bounds[1:])
                offsets = pa.array(bounds.astype(np.int32))
                out = pa.RecordBatch.from_arrays([
                    ids.slice(first, rows), pa.array(n.astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int64)))], names=["doc_id", "n", "terms", "tf"])
                yield out.filter(pa.array(n > 0))
    return count


class ImpactLists:
    """Lists of one chunk of documents: per term its documents, the largest impact first."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        sorted_term = term[order]
        self.known, self.begin = np.unique(sorted_term, return_index=True)
        self.finish = np.append(self.begin[1:], len(sorted_term))
        # For direct access: the documents of a list in their own order, with the position of each.
        by_doc = np.lexsort((self.doc, sorted_term))
        self.sorted_doc, self.position = self.doc[by_doc], by_doc

    def of(self, wanted: np.ndarray) -> list[tuple[int, int]]:
        """Bounds of the lists of terms, where the chunk has any."""
        wanted = np.intersect1d(wanted, self.known, assume_unique=True)
        at = np.searchsorted(self.known, wanted)
        return [(int(self.begin[a]), int(self.finish[a])) for a in at]


class Best:
    """The best so far of one item: scores and ids, equal scores by ascending id, null ids last."""

    __slots__ = ("score", "doc_id", "null")

    def __init__(self):
        self.score, self.doc_id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, doc_id: np.ndarray, null: np.ndarray, k: int) -> None:
        score, doc_id, null = (np.concatenate(p) for p in ((self.score, score), (self.doc_id, doc_id), (self.null, null)))
        order = np.lexsort((doc_id, null, -score))[:k]
        self.score, self.doc_id, self.null = score[order], doc_id[order], null[order]

    def kth(self, k: int) -> int:
        return int(self.score[k - 1]) if len(self.score) >= k else 0


def best_positions(lists: ImpactLists, wanted: np.ndarray, ids: np.ndarray, null: np.ndarray, best: Best, k: int) -> int:
    """Answer one item from the lists of a chunk; returns the number of positions read in order."""
    spans = lists.of(wanted)
    seen = [np.zeros(end - begin, bool) for begin, end in spans]
    position = [0] * len(spans)  # positions before this one have all been seen
    met = np.zeros(len(ids), bool)
    read, step, accesses = 0, READ, 0
    while spans:
        fresh = [lists.doc[begin + read: min(begin + read + step, end)] for begin, end in spans]
        accesses += sum(map(len, fresh))
        fresh = np.concatenate(fresh)
        fresh = np.unique(fresh[~met[fresh]])
        met[fresh] = True
        score = np.zeros(len(fresh), np.int64)
        bound = 0
        for i, (begin, end) in enumerate(spans):
            own = lists.sorted_doc[begin:end]
            spot = np.minimum(np.searchsorted(own, fresh), end - begin - 1)
            hit = own[spot] == fresh
            where = lists.position[begin + spot[hit]]
            score[hit] += lists.impact[where]
            seen[i][where - begin] = True
            ahead = seen[i][position[i]:]
            position[i] += int(np.argmin(ahead)) if not ahead.all() else len(ahead)
            if position[i] < end - begin:
                bound += int(lists.impact[begin + position[i] - 1])
        some = score > 0
        best.add(score[some], ids[fresh[some]], null[fresh[some]], k)
        if bound < best.kth(k) or all(p == end - begin for p, (begin, end) in zip(position, spans, strict=True)):
            break
        read, step = read + step, 2 * step
    return accesses


def _impacts(n: np.ndarray, doc: np.ndarray, tf: np.ndarray, weight: np.ndarray, docs: int, all_terms: int) -> np.ndarray:
    """Whole-number impacts of postings; products beyond 64 bits are taken in Python's integers."""
    if int(n.max(initial=0)) * 90 * docs < 1 << 62:
        m = 10 + (90 * n * docs) // all_terms
    else:
        m = np.array([10 + (90 * int(x) * docs) // all_terms for x in n], np.int64)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))


def _rank(block, docs: int, all_terms: int, k: int):
    """(item, doc_id, score) of the k best of each item among the documents of a task."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = block.value
        best = [Best() for _ in items]
        held: list[pa.RecordBatch] = []

        def answer() -> None:
            table = pa.Table.from_batches(held)
            held.clear()
            length = pc.list_value_length(table["terms"]).to_numpy()
            term = pc.list_flatten(table["terms"]).to_numpy().astype(np.int64)
            tf = pc.list_flatten(table["tf"]).to_numpy()
            doc = np.repeat(np.arange(table.num_rows), length)
            ids = table["doc_id"].fill_null(0).to_numpy()
            null = table["doc_id"].is_null().to_numpy()
            impact = _impacts(table["n"].to_numpy(), doc, tf, weights[term], docs, all_terms)
            some = impact > 0
            lists = ImpactLists(doc[some], term[some], impact[some])
            for wanted, own in zip(items, best, strict=True):
                best_positions(lists, wanted, ids, null, own, k)

        rows = postings = 0
        for batch in batches:
            for piece in _pieces(batch):
                held.append(piece)
                rows += piece.num_rows
                postings += len(piece.column(2).flatten())
                if rows >= CHUNK_DOCS or postings >= CHUNK_POSTINGS:
                    answer()
                    rows = postings = 0
        if held:
            answer()
        item = np.repeat(np.arange(len(items)), [len(b.score) for b in best])
        if len(item):
            ids, null = (np.concatenate([getattr(b, name) for b in best]) for name in ("doc_id", "null"))
            yield pa.RecordBatch.from_arrays([
                pa.array(item), pa.array(ids, mask=null), pa.array(np.concatenate([b.score for b in best]))],
                names=["item", "doc_id", "score"])
    return rank


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch cut so that no piece holds many more postings than a chunk."""
    postings = len(batch.column(2).flatten())
    step = max(1, batch.num_rows * CHUNK_POSTINGS // max(postings, CHUNK_POSTINGS))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of every item in code point order."""
    text = F.translate(F.coalesce("text", F.lit("")), _UPPER, _UPPER.lower())
    found = F.regexp_extract_all(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    return items.select("item_id", F.array_sort(F.array_distinct(found)).alias("terms"))


def _blocks(items: DataFrame, most: int) -> Iterator[list]:
    """Items in blocks whose terms stay below ``most`` bytes; a larger item is a block alone."""
    block, size = [], 0
    for row in items.toLocalIterator():
        own = sum(map(len, row.terms)) * 4
        if block and size + own > most:
            yield block
            block, size = [], 0
        block.append(row)
        size += own
    if block:
        yield block


def _search_block(spark: SparkSession, docs: DataFrame, block: list, k: int, scratch: Scratch) -> DataFrame:
    sc = spark.sparkContext
    lexicon = Lexicon(list({t for row in block for t in row.terms}))
    sent = sc.broadcast(lexicon)
    counted = scratch.store(docs.select("doc_id", "text").mapInArrow(
        _count(sent), "doc_id bigint, n bigint, terms array<int>, tf array<bigint>"), "postings")
    sent.unpersist()
    totals = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    n_docs, all_terms = totals[0], totals[1] or 1
    weights = np.zeros(len(lexicon.words), np.int64)
    # One row per term of the block at most.
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
        weights[row.term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row.df + 1)))
    number = {w: i for i, w in enumerate(lexicon.words)}
    wanted = [np.array(sorted(number[t] for t in row.terms), np.int64) for row in block]
    sent = sc.broadcast((wanted, weights))
    found = scratch.store(counted.where(F.size("terms") > 0).mapInArrow(
        _rank(sent, n_docs, all_terms, k), "item bigint, doc_id bigint, score bigint"), "found")
    sent.unpersist()
    scratch.drop(counted)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(block)], "item bigint, item_id bigint")
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The k highest-scoring rows of ``docs`` (doc_id, text) for every row of ``items`` (item_id, text).

    Returns item_id, rank (int, from 1), doc_id, score (bigint).  More columns are not read.  Null
    texts have no terms; items without terms, and a table without documents or without items, give no
    rows.  Only scores above 0 count; equal scores go by ascending doc_id, null ids last.  Repeated
    documents are ranked one by one, repeated items are answered each for itself.  Whole texts are read.
    The corpus is read once for each block of items.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    out = None
    for block in _blocks(item_terms(items).where(F.size("terms") > 0), item_bytes):
        found = _search_block(spark, docs, block, k, scratch)
        out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return out
