"""Spelling variants by Bloom-guided neighbourhoods.

The vocabulary (words and counts of all documents) is hashed into blocked Bloom filters, one shard of
blocks per word length.  Every word then generates its edits, tests them against the filter and sends
only the positives on; an exact join with the vocabulary removes the false ones.  Each pair of near
words is generated once, from the longer word by a deletion or from the word with the smaller letter by
a replacement, and turned round after the join: an insertion is a deletion seen from the other side.

A filter is broadcast in windows of a fixed size.  A vocabulary that needs more blocks than a
window holds is probed window by window, each time by the words whose edits can fall into it, so
that neither the driver nor a worker holds more than one window, and no word is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.storage import Scratch
from fieldbook.llm.words import mix

LEAST_LENGTH = 7      # code points of a word
LEAST_COUNT = 2       # occurrences of a word
CUT = 31              # a run loses a code point where its checksum divides by this
RATIO = 10            # a form occurs at least so many times as often
BITS_PER_WORD = 24
WINDOW_BYTES = 32 << 20   # filter bytes that are broadcast at once
LONG = 64             # words of this length and more share a shard
CHUNK = 8192          # blocks of eight bytes that one row of the stored filter holds
PROBES = 1 << 20      # edits tested at once in a task

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_B = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
_B_INVERSE = pow(_B, -1, 1 << 64)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the runs of letters of all documents, after the cut by checksum.  A null id counts as an empty one."""
    # Runs too short to give a word are not matched at all; the longer ones are still maximal.
    pattern = f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}"
    runs = docs.select(F.col("doc_id"), F.explode(F.regexp_extract_all(
        F.coalesce("text", F.lit("")), F.lit(pattern), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", F.translate("run", _UPPER, _UPPER.lower()).alias("run"))
    sums = runs.select("run", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                                               F.col("run"))).alias("h"))
    at = F.expr("cast(h % length(run) as int)")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.expr("substring(run, cast(h % length(run) as int) + 2)"))
    words = sums.select(F.when(F.col("h") % CUT == 0, cut).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


class _Shards:
    """Blocks of eight bytes of each word length, one after the other."""

    def __init__(self, counts: dict[int, int]):
        self.blocks = np.zeros(LONG + 1, np.uint64)
        for length, words in counts.items():
            self.blocks[length] = -(-words * BITS_PER_WORD // 64)
        self.offset = np.zeros(LONG + 2, np.int64)
        np.cumsum(self.blocks.astype(np.int64), out=self.offset[1:])
        self.total = int(self.offset[-1])

    def place(self, value: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Block number and the bits of a hashed word of ``length`` code points."""
        shard = min(length, LONG)
        key = mix(value + np.uint64(length))
        block = ((key >> np.uint64(32)) * self.blocks[shard]) >> np.uint64(32)
        one, six = np.uint64(1), np.uint64(63)
        bits = one << (key & six)
        for shift in (6, 12, 18):
            bits |= one << ((key >> np.uint64(shift)) & six)
        return block.astype(np.int64) + self.offset[shard], bits

    def has(self, length: int, low: int, high: int) -> bool:
        """Whether words of this length have blocks in low .. high - 1."""
        shard = min(length, LONG)
        return bool(self.blocks[shard]) and self.offset[shard] < high and self.offset[shard + 1] > low


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, code points as a matrix) of the words of each length, in pieces of bounded size."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        every = np.flatnonzero(lengths == length)
        step = max(1, PROBES // int(length))
        for rows in np.split(every, range(step, len(every), step)):
            text = "".join([words[r] for r in rows])
            yield int(length), rows, np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(rows), length).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    steps = np.full(n, _B, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _marks(shards: _Shards):
    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, code in _by_length(batch.column(0).to_pylist()):
                block, bits = shards.place((code * _powers(length)).sum(axis=1, dtype=np.uint64), length)
                yield pa.RecordBatch.from_arrays([
                    pa.array((block // CHUNK).astype(np.int64)), pa.array((block % CHUNK).astype(np.int32)),
                    pa.array(bits.view(np.int64))], names=["chunk", "at", "bits"])
    return marks


def _merge_chunk(rows: pd.DataFrame) -> pd.DataFrame:
    held = np.zeros(CHUNK, np.uint64)
    np.bitwise_or.at(held, rows["at"].to_numpy(), rows["bits"].to_numpy().view(np.uint64))
    return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "data": [held.tobytes()]})


def _probe(shards: _Shards, alphabet: np.ndarray, window, low: int, high: int):
    """Edits of words that the blocks low .. high - 1 of the filter may hold: (word, n, edit)."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(window.value, np.uint64)

        def positive(value: np.ndarray, length: int) -> np.ndarray:
            block, bits = shards.place(value, length)
            near = np.flatnonzero((block >= low) & (block < high)) if low or high < shards.total else slice(None)
            hit = (held[block[near] - low] & bits[near]) == bits[near]
            return np.flatnonzero(hit) if isinstance(near, slice) else near[hit]

        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1)
            source, edits = [], []
            for length, rows, code in _by_length(words):
                power = _powers(length)
                step = max(1, PROBES // (length * max(len(alphabet), 1)))
                for begin in range(0, len(rows), step):
                    part, own = code[begin: begin + step], rows[begin: begin + step]
                    terms = part * power
                    after = np.cumsum(terms, axis=1, dtype=np.uint64)
                    total = after[:, -1:]
                    if shards.has(length - 1, low, high):
                        value = after - terms + (total - after) * np.uint64(_B_INVERSE)
                        # A letter equal to the one before gives the same word again.
                        fresh = np.ones(part.shape, bool)
                        fresh[:, 1:] = part[:, 1:] != part[:, :-1]
                        r, at = np.nonzero(fresh)
                        for k in positive(value[fresh], length - 1):
                            word = words[own[r[k]]]
                            source.append(own[r[k]])
                            edits.append(word[:at[k]] + word[at[k] + 1:])
                    if shards.has(length, low, high):
                        span = max(1, PROBES // (len(own) * max(len(alphabet), 1)))
                        for left in range(0, length, span):  # more than once for a very long word only
                            r, at, letter = np.nonzero(alphabet[None, None, :] > part[:, left: left + span, None])
                            at += left
                            value = total[r, 0] + (alphabet[letter] - part[r, at]) * power[at]
                            for k in positive(value, length):
                                word = words[own[r[k]]]
                                source.append(own[r[k]])
                                edits.append(word[:at[k]] + chr(alphabet[letter[k]]) + word[at[k] + 1:])
            taken = pa.array(np.asarray(source, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), counts.take(taken), pa.array(edits, pa.string())],
                                             names=["word", "n", "edit"])
    return probe


def _positives(words: DataFrame, scratch: Scratch, window_bytes: int) -> DataFrame | None:
    """(word, n, edit) of the edits that the filter lets through; None without words.

    The driver sees a count per length, the letters in use (at most 90) and one window of the filter at a time.
    """
    spark = words.sparkSession
    counts = {r.l: r.c for r in words.groupBy(F.least(F.length("word"), F.lit(LONG)).alias("l"))
              .agg(F.count(F.lit(1)).alias("c")).collect()}
    if not counts:
        return None
    shards = _Shards(counts)
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).distinct().where("letter <> ''").collect()
    alphabet = np.array(sorted(ord(r.letter) for r in letters), np.uint64)
    marks = words.select("word").mapInArrow(_marks(shards), "chunk bigint, at int, bits bigint")
    stored = scratch.store(marks.groupBy("chunk").applyInPandas(_merge_chunk, "chunk bigint, data binary"), "filter")
    per_window = max(1, window_bytes // (8 * CHUNK))
    out = None
    for first in range(0, -(-shards.total // CHUNK), per_window):
        last = min(first + per_window, -(-shards.total // CHUNK))
        held = bytearray((last - first) * CHUNK * 8)
        for row in stored.where(f"chunk >= {first} and chunk < {last}").toLocalIterator():
            at = (row.chunk - first) * CHUNK * 8
            held[at: at + CHUNK * 8] = row.data
        low, high = first * CHUNK, last * CHUNK
        asked = [n for n in counts if shards.has(n, low, high) or shards.has(n - 1, low, high)]
        window = spark.sparkContext.broadcast(bytes(held))
        # A long word's deletion can fall into its own shard, so the longest shard always asks with itself.
        sources = words.where(F.least(F.length("word"), F.lit(LONG)).isin(asked))
        found = scratch.store(sources.mapInArrow(_probe(shards, alphabet, window, low, high),
                                                 "word string, n bigint, edit string"), "positives")
        window.unpersist()
        out = found if out is None else out.union(found)
    return out


def near_words(words: DataFrame, scratch: Scratch, window_bytes: int = WINDOW_BYTES) -> DataFrame:
    """(word, n, near, near_n), both ways, for words (word, n) that differ by one inserted, deleted or replaced code point."""
    positives = _positives(words, scratch, window_bytes)
    if positives is None:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).where("false")
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = positives.join(known, positives["edit"] == known["near"]).select("word", "n", "near", "near_n")
    return pairs.select(F.explode(F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )).alias("p")).select("p.*")


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) for forms (word, form): each round doubles the steps that are followed.

    A form occurs ten times as often as its word, so a chain has fewer than twenty steps and
    five rounds end it.
    """
    now = scratch.store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = scratch.store(now.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not longer.agg(F.max("moved")).first()[0]:
            return now
        now = longer.select("word", "root")


def spelling_variants(docs: DataFrame, window_bytes: int = WINDOW_BYTES) -> DataFrame:
    """Near words, form and root of every word of ``docs`` (doc_id bigint, text string; more columns are not read).

    Returns word, form, root, n, n_near, form_n.  A null text has no words, a null id counts as an empty
    one, repeated rows count as often as they stand, an empty table gives no rows.  Of near words with equal
    counts the smallest in code point order is the form.  Texts are read whole and words may have any length.
    """
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.store(word_counts(docs), "words")
    around = (near_words(words, scratch, window_bytes)
              .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                   F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("best")))
    around = scratch.store(around.select("word", "n_near", F.col("best.near").alias("best"), (-F.col("best.m")).alias("best_n")), "near")
    joined = words.join(around, "word", "left")
    is_form = F.col("best_n") >= RATIO * F.col("n")
    formed = scratch.store(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                         F.when(is_form, F.col("best")).alias("form"),
                                         F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    roots = _roots(formed.where("form is not null"), scratch)
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.col("n_near").cast("bigint").alias("n_near"), "form_n")
