"""Operator 3: supervised subword embeddings for document quality.

A document is the average of learned vectors of its words, character n-grams and repeated
word trigrams, hashed to ``2 * BUCKETS`` rows; a softmax layer on the average gives the score.  Training is
numpy stochastic gradient descent on at most ``SAMPLE`` labelled rows (a documented bound;
they are the rows whose hashed ids are smallest, so every source is sampled alike).  Only
their hashed counts reach the driver.  Every whole text is scored in the tasks; the model
they get has a fixed size (``2 * BUCKETS * WIDTH`` float32, 4 MB).

Edge cases.  A null or blank text gets the score of the bias alone.  A null doc_id is not
held out.  Null labels and labels without a document are not learned from; of repeated
labels the smallest counts.  Without labels every score is 0.5.  Repeated rows are scored
alike.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.words import Block, blocks, mix

BUCKETS = 1 << 15
WIDTH = 16
GRAMS = (3, 4)
SAMPLE = 4000
EPOCHS = 12
RATE = 0.8
HELD_OUT = "pmod(crc32(cast(doc_id as string)), 3) = 1"


class Model(NamedTuple):
    vectors: np.ndarray  # (2 * BUCKETS, WIDTH)
    weights: np.ndarray  # (WIDTH, 2)
    bias: np.ndarray  # (2,)


def _features(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every row: bucket numbers of its words and n-grams, and how often each occurs."""
    mask = np.uint64(BUCKETS - 1)
    word = (block.hash & mask).astype(np.int64) + BUCKETS
    data = block.data.astype(np.uint64) + np.uint64(1)
    bounds = _row_bounds(block)
    grams = []
    for n in GRAMS:
        size = max(len(data) - n + 1, 0)
        value = np.full(size, n, dtype=np.uint64)
        for k in range(n):
            value = value * np.uint64(0x100000001B3) + data[k: size + k]
        grams.append((mix(value) & mask).astype(np.int64))
    for r in range(block.rows):
        lo, hi = bounds[r], bounds[r + 1]
        own = [g[lo: max(lo, hi - n + 1)] for n, g in zip(GRAMS, grams, strict=True)]
        own.append(word[block.at[r]: block.at[r + 1]])
        again = _seen_before(block.hash[block.at[r]: block.at[r + 1]])
        own.append(np.full(again, 2 * BUCKETS - 1))
        counts = np.bincount(np.concatenate(own), minlength=1)
        at = np.flatnonzero(counts)
        yield at, counts[at]


def _seen_before(words: np.ndarray) -> int:
    """Word trigrams of a row that repeat an earlier one; they share one bucket, whatever the words."""
    if len(words) < 4:
        return 0
    odd = np.uint64(0x9FB21C651E98DF25)
    value = (words[:-2] * odd + words[1:-1]) * odd + words[2:]
    return len(value) - len(np.unique(value))


def _row_bounds(block: Block) -> np.ndarray:
    """Byte span from the first word to the last of each row, as cut points."""
    bounds = np.zeros(block.rows + 1, dtype=np.int64)
    bounds[-1] = len(block.data)
    has = np.diff(block.at) > 0
    begin = np.full(block.rows, -1, dtype=np.int64)
    begin[has] = block.start[block.at[:-1][has]]
    nxt = len(block.data)
    for r in range(block.rows - 1, -1, -1):
        nxt = begin[r] if begin[r] >= 0 else nxt
        bounds[r] = nxt
    return bounds


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 5) -> Model:
    """Gradient descent over (buckets, counts, label) rows, one document a step, with a falling rate."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (2 * BUCKETS, WIDTH)).astype(np.float32)
    model = Model(vectors, np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32))
    parts = [row for row in rows if len(row[0])]
    steps, done = max(1, epochs * len(parts)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(parts)):
            at, n, y = parts[k]
            share = (n / n.sum(dtype=np.int64)).astype(np.float32)
            lr = np.float32(rate * (1 - done / steps))
            done += 1
            mean = share @ vectors[at]
            error = _softmax(mean @ model.weights + model.bias)
            error[y] -= 1
            back = model.weights @ error
            model.weights[...] -= lr * np.outer(mean, error)
            model.bias[...] -= np.float32(0.1) * lr * error
            # The step of a bucket follows its share, scaled so that long texts also learn.
            vectors[at] -= lr * np.sqrt(share)[:, None] * back[None, :]
    return model


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def _collected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column(0), lower=False):
            at, n = [], []
            for a, c in _features(block):
                at.append(a.astype(np.uint16 if 2 * BUCKETS <= 1 << 16 else np.uint32).tobytes())
                n.append(np.minimum(c, 0xFFFF).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(block.first, block.rows), pa.array(at, pa.binary()),
                                              pa.array(n, pa.binary())], names=["label", "at", "n"])


def held_out() -> Column:
    return F.coalesce(F.expr(HELD_OUT), F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Train on at most ``sample`` rows of ``docs`` that ``labels`` (doc_id, quality) marks and the fold allows."""
    known = (labels.where("quality in (0, 1) and doc_id is not null").where(~held_out())
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label")))
    chosen = (docs.select("doc_id").distinct().join(known, "doc_id")
              .orderBy(F.xxhash64(F.col("doc_id"), F.lit("sample")), "doc_id").limit(sample))
    rows = (docs.select("doc_id", "text").join(chosen, "doc_id").dropDuplicates(["doc_id"])
            .select("text", "label").mapInArrow(_collected, "label int, at binary, n binary")).toArrow()
    # The driver holds the counts once, as they came: two bytes a bucket and two a count.
    order = sorted(zip(*(c.to_pylist() for c in rows.columns), strict=True))  # the same steps in every run
    del rows
    wide = np.uint16 if 2 * BUCKETS <= 1 << 16 else np.uint32
    parts = [(np.frombuffer(a, wide), np.frombuffer(n, np.uint16), y) for y, a, n in order]
    return train(parts) if parts else None


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), lower=False):
                out = np.empty(block.rows)
                for r, (at, n) in enumerate(_features(block)):
                    z = model.bias.astype(np.float64)
                    if len(at):
                        share = (n / n.sum()).astype(np.float32)
                        z = (share @ model.vectors[at]) @ model.weights + z
                    out[r] = _softmax(z)[1]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.rows), pa.array(out)],
                                                 names=["doc_id", "score"])
    return score


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Quality of every document (doc_id, text): doc_id, held_out, score (0 to 1), predicted (0 or 1)."""
    model = fit(docs, labels, sample)
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if model is None:
        scored = ids.select("doc_id", F.lit(0.5).alias("score"))
    else:
        scored = ids.mapInArrow(_scorer(model), "doc_id bigint, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _keeper(model: Model, text_at: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(model)
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(text_at), batch.column(text_at)], names=["doc_id", "text"])
            scores = np.concatenate([b.column(1).to_numpy() for b in score(iter([texts]))] or [np.zeros(0)])
            yield batch.filter(pa.array(scores >= 0.5))
    return keep


def keep_accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text the model scores at 0.5 or more, with all their columns."""
    return docs.mapInArrow(_keeper(model, docs.columns.index("text")), docs.schema)
