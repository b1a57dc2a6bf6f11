"""Operator 1: near-duplicate groups by a MinHash LSH forest.

Every text becomes its set of distinct five-word shingles.  A signature of
``TREES * DEPTH`` MinHash values is cut into ``TREES`` labels of ``DEPTH`` values; a
tree is the sorted order of one label.  Texts that share a label prefix are
candidates if the first ``MIN_DEPTH`` values of a label agree, however many texts share them.

Links are confirmed on full shingle sets, in two sweeps.  The first takes from every
region a spanning forest of its likely pairs and confirms those of the first
``FIRST_TREES`` trees one by one; where more than ``REGION_ROWS`` texts share a prefix it only
looks at longer prefixes, to form most groups cheaply.  The second finds every text that is
likely linked with a text of another group, and compares it with all texts of that group,
block by block.  It compares each region completely: a crowded one is split into
blocks, and every pair of blocks is a piece of work of its own.  A pair inside a group
cannot change the result, so leaving it out loses nothing, and blocks of one and the same
group are not brought together.

Edge cases.  Null and blank texts have an empty set and are linked with nothing.  Rows
with a null doc_id are left alone: their component is null and they are kept.  Repeated
rows share a component; rows that repeat a doc_id with another text get the component
of their own text.  Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.graph import components
from fieldbook.llm.storage import Scratch, dealt
from fieldbook.llm.words import blocks, mix, shingle_hashes

TREES = 16
DEPTH = 8  # values in a label
MIN_DEPTH = 2
FIRST_TREES = 4
GROUP_BLOCK = 256  # texts of a group that are compared in one piece
FILTER_BITS = 1 << 24  # fixed size of the filter that spares a shuffle of all texts
REGION_ROWS = 4096
VALUES = TREES * DEPTH
#: Equal signature values that make a pair worth an exact check: at a similarity of
#: 0.75 an average of 96 of 128 agree, with a deviation of 4.9.
LIKELY = 77
LINK = (75, 100)  # intersection >= 75 % of the union

SKETCH = "doc_id bigint, n_shingles bigint, key binary, labels binary, low binary"
_SMALL = 16
_COLUMNS = 4096


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:VALUES, None], seeds[VALUES:, None] | np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values (uint16 each) of a set of 64-bit shingle hashes."""
    flip, times = _multipliers()
    least = np.full(VALUES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), _COLUMNS):
        part = shingles[None, at: at + _COLUMNS] ^ flip
        part *= times
        np.minimum(least, part.min(axis=1), out=least)
    return (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for block in blocks(batch.column(1)):
            values, at = shingle_hashes(block)
            sizes, keys, labels, low = [], [], [], []
            for r in range(block.rows):
                own = np.unique(values[at[r]: at[r + 1]])
                sizes.append(len(own))
                if len(own):
                    sig = signature(own)
                    keys.append(_key(own))
                    labels.append(sig.astype(">u2").tobytes())
                    low.append((sig & 0xFF).astype(np.uint8).tobytes())
                else:
                    keys.append(None)
                    labels.append(None)
                    low.append(None)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(block.first, block.rows), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(labels, pa.binary()), pa.array(low, pa.binary())],
                names=["doc_id", "n_shingles", "key", "labels", "low"])


def _filter_bit(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64) + np.uint64(77)) % np.uint64(FILTER_BITS)).astype(np.int64)


def _filter_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(_filter_bit(batch.column(0).to_numpy())).astype(np.int32))], names=["bit"])


def _sets(wanted: bytes):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.unpackbits(np.frombuffer(zlib.decompress(wanted), np.uint8)).astype(bool)
        for batch in batches:
            ids = batch.column(0)
            some = bitmap[_filter_bit(ids.fill_null(0).to_numpy())] & ids.is_valid().to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(some))
            ids = batch.column(0)
            for block in blocks(batch.column(1)):
                values, at = shingle_hashes(block)
                own = [np.unique(values[at[r]: at[r + 1]]) for r in range(block.rows)]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
                flat = np.concatenate(own) if own else np.zeros(0, np.uint64)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(block.first, block.rows), lists], names=["node", "shingles"])
    return sets


class _Region:
    """Rows of a run of regions as arrays; all rows of one tree region are adjacent."""

    def __init__(self, batch: pa.Table):
        self.region = batch.column("region").to_numpy()
        self.node = batch.column("node").to_numpy()
        self.size = batch.column("n_shingles").to_numpy()
        self.group = batch.column("grp").to_numpy()
        self.weight = batch.column("weight").to_numpy()
        self.tree = batch.column("tree").to_numpy()
        low = b"".join(batch.column("low").to_pylist())
        self.low = np.frombuffer(low, dtype=np.uint8).reshape(-1, VALUES)

    def likely(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal signature values of row pairs; 0 where the sizes alone rule a link out."""
        equal = (self.low[i] == self.low[j]).sum(axis=1)
        a, b = self.size[i], self.size[j]
        return np.where(LINK[1] * np.minimum(a, b) >= LINK[0] * np.maximum(a, b), equal, 0)


def _forest(pairs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for equal, i, j in sorted(pairs, reverse=True):
        a, b = root(i), root(j)
        if a != b:
            parent[a] = b
            out.append((equal, i, j))
    return out


def _small_regions(rows: _Region, index: np.ndarray, region_of: np.ndarray, sizes: np.ndarray, forest: bool):
    """Likely pairs of the regions of two to ``_SMALL`` rows, by lag inside the sorted order."""
    found = []
    for lag in range(1, int(sizes.max(initial=1))):
        j = np.flatnonzero((sizes > lag)[region_of] & (index >= lag))
        if not len(j):
            break
        i = j - lag
        ok = rows.group[i] != rows.group[j]
        i, j = i[ok], j[ok]
        for at in range(0, len(i), 65536):
            equal = rows.likely(i[at: at + 65536], j[at: at + 65536])
            good = equal >= LIKELY
            found.append((equal[good], i[at: at + 65536][good], j[at: at + 65536][good]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    equal, i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    if not forest:
        return i, j
    single = sizes[region_of[i]] == 2
    out_i, out_j = [i[single]], [j[single]]
    by: dict[int, list] = {}
    for e, a, b in zip(equal[~single].tolist(), i[~single].tolist(), j[~single].tolist(), strict=True):
        by.setdefault(int(region_of[a]), []).append((e, a, b))
    kept = [x for pairs in by.values() for x in _forest(pairs)]
    out_i.append(np.array([x[1] for x in kept], dtype=np.int64))
    out_j.append(np.array([x[2] for x in kept], dtype=np.int64))
    return np.concatenate(out_i), np.concatenate(out_j)


def _large_region(rows: _Region, lo: int, hi: int, forest: bool, cross: int = 0):
    """Likely pairs of one large region: every row against all rows before it.

    With ``cross`` only the pairs of one of the first ``cross`` rows with one of the others.
    """
    columns = np.ascontiguousarray(rows.low[lo:hi].T)
    size, group = rows.size[lo:hi], rows.group[lo:hi]
    n = hi - lo
    parent = np.arange(n)
    out_i, out_j = [], []
    for start in range(cross, n, 256):
        stop = min(start + 256, n)
        equal = np.zeros((stop - start, cross or stop), dtype=np.uint8)
        for c in range(VALUES):
            equal += columns[c, start:stop, None] == columns[c, None, :cross or stop]
        for r in range(start, stop):
            before = cross or r
            likely = equal[r - start, :before] >= LIKELY
            likely &= group[:before] != group[r]
            a = size[:before]
            likely &= LINK[1] * np.minimum(a, size[r]) >= LINK[0] * np.maximum(a, size[r])
            js = np.flatnonzero(likely)
            if not len(js):
                continue
            if forest:  # the likeliest row of every tree that the forest has so far
                js = js[np.argsort(-equal[r - start, js].astype(np.int64), kind="stable")]
                _, first = np.unique(parent[js], return_index=True)
                js = js[first]
                parent[np.isin(parent, parent[js])] = r
            out_i.append(js + lo)
            out_j.append(np.full(len(js), r + lo))
    if not out_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_i), np.concatenate(out_j)


def _pairs_in(table: pa.Table, forest: bool) -> pa.RecordBatch:
    rows = _Region(table)
    n = len(rows.node)
    first = np.flatnonzero(np.concatenate([[True], rows.region[1:] != rows.region[:-1]]))
    sizes = np.diff(np.append(first, n))
    region_of = np.repeat(np.arange(len(first)), sizes)
    index = np.arange(n) - first[region_of]
    small = np.where(sizes <= _SMALL, sizes, 0)
    parts = [_small_regions(rows, index, region_of, small, forest)]
    for k in np.flatnonzero(sizes > _SMALL):
        parts.append(_large_region(rows, int(first[k]), int(first[k] + sizes[k]), forest))
    i = np.concatenate([p[0] for p in parts])
    j = np.concatenate([p[1] for p in parts])
    if forest:
        a, b = rows.node[i], rows.node[j]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(rows.tree[i] < FIRST_TREES)],
                                          names=["u", "v", "mark"])
    asks = _asks(rows, i, j)
    return pa.RecordBatch.from_arrays([pa.array(asks[:, 0]), pa.array(asks[:, 1]), pa.array(np.ones(len(asks), bool))], names=["u", "v", "mark"])


def _asks(rows: _Region, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Text and group of row pairs: the text of the smaller group asks; of equal groups that with the larger number."""
    turn = (rows.weight[i] > rows.weight[j]) | ((rows.weight[i] == rows.weight[j]) & (rows.group[i] < rows.group[j]))
    i, j = np.where(turn, j, i), np.where(turn, i, j)
    return np.unique(np.stack([rows.node[i], rows.group[j]], axis=1), axis=0) if len(i) else np.zeros((0, 2), np.int64)


def _compare_blocks(table: pa.Table) -> pa.Table:
    """Asks between the two blocks of one piece of work, or inside its single block."""
    table = table.sort_by("side")
    rows = _Region(table)
    cross = int((table.column("side").to_numpy() == 0).sum()) % table.num_rows  # 0 if there is one block
    asks = _asks(rows, *_large_region(rows, 0, table.num_rows, False, cross))
    return pa.table([pa.array(asks[:, 0]), pa.array(asks[:, 1])], names=["u", "v"])


def _sweep(forest: bool, region_rows: int):
    """Pass over partitions sorted by region; a region that spans batches is put together first.

    A region larger than ``region_rows`` (texts whose whole labels agree) is looked at
    in overlapping blocks, so that memory stays bounded; ``sweep_crowded`` compares it completely.
    """
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            region = held.column("region").to_numpy()
            last = int(np.searchsorted(region, region[-1], side="left")) if (np.diff(region) >= 0).all() else \
                int(np.flatnonzero(region != region[-1])[-1]) + 1
            if last:
                yield _pairs_in(held.slice(0, last), forest)
                held = held.slice(last)
            while held.num_rows > 2 * region_rows:
                yield _pairs_in(held.slice(0, 2 * region_rows), forest)
                held = held.slice(region_rows)
        if held is not None and held.num_rows:
            yield _pairs_in(held, forest)
    return sweep


def _tree_rows(classes: DataFrame) -> DataFrame:
    return (classes.select("node", "n_shingles", "grp", "weight", "labels", "low",
                           F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
            .select("tree", "node", "n_shingles", "grp", "weight", "low",
                    F.expr(f"substring(labels, 1 + tree * {2 * DEPTH}, {2 * DEPTH})").alias("label")))


def _crowded(classes: DataFrame, region_rows: int, scratch: Scratch) -> list[DataFrame]:
    """For each depth from ``MIN_DEPTH``, the label prefixes that more than ``region_rows`` texts share."""
    rows, out = _tree_rows(classes).select("tree", "label"), []
    for depth in range(MIN_DEPTH, DEPTH):
        rows = rows.withColumn("prefix", F.expr(f"substring(label, 1, {2 * depth})"))
        level = scratch.store(rows.groupBy("tree", "prefix").count().where(F.col("count") > region_rows)
                              .select("tree", "prefix"), f"crowded-{depth}")
        if level.isEmpty():
            break
        out.append(level)
        rows = rows.join(level, ["tree", "prefix"], "left_semi")
    return out


def sweep(classes: DataFrame, crowded: list[DataFrame], forest: bool, region_rows: int = REGION_ROWS) -> DataFrame:
    """Compare the texts (node, n_shingles, grp, weight, labels, low) of every region, leaving out pairs within a ``grp``.

    With ``forest``: likely pairs (u < v), and whether one of the first trees gave it.  Otherwise:
    texts u that are likely linked with a text of the group v, without the crowded regions.
    """
    rows = _tree_rows(classes) if forest or not crowded else _crowded_rows(classes, crowded, "left_anti").drop("prefix")
    rows = rows.withColumn("depth", F.lit(MIN_DEPTH))
    for depth, level in enumerate(crowded if forest else [], MIN_DEPTH):
        mark = level.select("tree", F.col("prefix").alias("p"), F.lit(True).alias("deeper"))
        rows = (rows.withColumn("p", F.expr(f"substring(label, 1, {2 * depth})")).join(mark, ["tree", "p"], "left")
                .withColumn("depth", F.when(F.col("deeper"), F.lit(depth + 1)).otherwise(F.col("depth")))
                .drop("p", "deeper"))
    rows = rows.withColumn("region", F.xxhash64("tree", F.expr("substring(label, 1, 2 * depth)")))
    ordered = (rows.select("region", "label", "tree", "node", "n_shingles", "grp", "weight", "low").repartition("region")
               .sortWithinPartitions("region", "label", "node").drop("label"))
    found = ordered.mapInArrow(_sweep(forest, region_rows), "u bigint, v bigint, mark boolean")
    return found.groupBy("u", "v").agg(F.max("mark").alias("mark"))


def _crowded_rows(classes: DataFrame, crowded: list[DataFrame], kind: str) -> DataFrame:
    """Tree rows whose shortest prefix is crowded (``left_semi``) or not (``left_anti``)."""
    return (_tree_rows(classes).withColumn("prefix", F.expr(f"substring(label, 1, {2 * MIN_DEPTH})"))
            .join(crowded[0], ["tree", "prefix"], kind))


def sweep_crowded(classes: DataFrame, crowded: list[DataFrame], scratch: Scratch, region_rows: int = REGION_ROWS) -> DataFrame:
    """Texts u that are likely linked with a text of the group v, for all pairs of texts in a crowded region.

    A group of more than ``region_rows`` texts in a region has blocks of its own, the other texts share
    blocks.  Only blocks that are not of one and the same group are compared.
    """
    rows = (_crowded_rows(classes, crowded, "left_semi")
            .select(F.xxhash64("tree", "prefix").alias("region"), "tree", "node", "n_shingles", "grp", "weight", "low"))
    per = scratch.store(rows.groupBy("region", "grp").agg(F.count(F.lit(1)).alias("n")), "crowd-sizes")
    pieces = F.ceil(F.col("n") / region_rows).cast("int").alias("pieces")
    alone = per.where(F.col("n") > region_rows).select("region", F.col("grp").alias("own"), pieces)
    shared = per.where(F.col("n") <= region_rows).groupBy("region").agg(F.sum("n").alias("n")).select("region", pieces)
    kinds = scratch.store(alone.withColumn("pooled", F.lit(False)).select("region", "pooled", "own", "pieces").union(
        shared.select("region", F.lit(True), F.lit(0).cast("bigint"), "pieces")), "crowd-kinds")

    a, b = (kinds.select("region", F.struct("pooled", "own").alias(x), F.col("pieces").alias(f"{x}_pieces")) for x in "ab")
    same = F.col("a") == F.col("b")
    work = (a.join(b, "region").where((F.col("a") < F.col("b")) | (same & F.col("a.pooled")))
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("a_pieces") - 1)))
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("b_pieces") - 1)))
            .where(~same | (F.col("i") <= F.col("j"))).withColumn("work", F.monotonically_increasing_id()))
    work = scratch.store(work.select("work", "region", "a", "b", "i", "j"), "crowd-work")
    first = work.select("work", "region", F.lit(0).alias("side"), "a.pooled", "a.own", F.col("i").alias("piece"))
    second = (work.where((F.col("a") != F.col("b")) | (F.col("i") != F.col("j")))
              .select("work", "region", F.lit(1).alias("side"), "b.pooled", "b.own", F.col("j").alias("piece")))

    key = ["region", "pooled", "own", "piece"]
    big = alone.select("region", F.col("own").alias("grp"), F.col("pieces").alias("own_pieces"))
    small = shared.withColumnRenamed("pieces", "shared_pieces")
    placed = (rows.join(big, ["region", "grp"], "left").join(small, "region", "left")
              .withColumn("pooled", F.col("own_pieces").isNull())
              .withColumn("own", F.when(F.col("pooled"), F.lit(0)).otherwise(F.col("grp")))
              .withColumn("piece", F.pmod(F.xxhash64("node"), F.coalesce("own_pieces", "shared_pieces")).cast("int")))
    sent = (placed.join(first.union(second), key)
            .select("work", "side", F.col("region"), "tree", "node", "n_shingles", "grp", "weight", "low"))
    return sent.groupBy("work").applyInArrow(_compare_blocks, "u bigint, v bigint").distinct()


def shingle_sets(docs: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, shingles) of the documents in ``nodes``, stored.

    A filter of fixed size goes to the tasks first, so that texts which nobody asked for are
    not shuffled; the join after it is exact.
    """
    bits = nodes.mapInArrow(_filter_bits, "bit int").distinct().toArrow().column(0).to_numpy()
    bitmap = np.zeros(FILTER_BITS, dtype=bool)
    bitmap[bits] = True
    packed = zlib.compress(np.packbits(bitmap).tobytes(), 1)
    made = docs.select("doc_id", "text").mapInArrow(_sets(packed), "node bigint, shingles array<bigint>")
    return scratch.store(made.join(nodes, "node", "left_semi"), "sets")


def _linked(both, a, b):
    return LINK[1] * both >= LINK[0] * (a + b - both)


def confirm_pairs(pairs: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (u, v) whose full shingle sets reach the link threshold."""
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    both = pairs.join(a, "u").join(b, "v").withColumn("both", F.size(F.array_intersect("a", "b")))
    return scratch.store(both.where(_linked(F.col("both"), F.size("a"), F.size("b"))).select("u", "v"), "links")


def _ask_block(key, members: pa.Table, asking: pa.Table) -> pa.Table:
    """Texts that ask, linked with the first text of the block that reaches the threshold."""
    out = []
    if members.num_rows:
        nodes = members.column("node").to_numpy()
        own = [x.values.to_numpy() for x in members.column("shingles")]
        sizes = np.array([len(x) for x in own])
        flat, starts = np.concatenate(own), np.concatenate([[0], np.cumsum(sizes)[:-1]])
        for node, shingles in zip(asking.column("u").to_pylist(), asking.column("asked"), strict=True):
            mine = shingles.values.to_numpy()
            at = np.minimum(np.searchsorted(mine.view(np.uint64), flat.view(np.uint64)), len(mine) - 1)
            both = np.add.reduceat((mine[at] == flat).astype(np.int64), starts)
            hit = np.flatnonzero(_linked(both, sizes, len(mine)))
            if len(hit):
                out.append((node, int(nodes[hit[0]])))
    return pa.table([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["u", "v"])


def confirm_groups(asks: DataFrame, groups: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """Links between texts u and texts of group v, for asks (u, v); ``groups`` has (node, grp, weight).

    Both the texts that ask for a group and the group's own texts are dealt into blocks of at most about ``GROUP_BLOCK``;
    each pair of blocks is a piece of work of its own, however large the group and however many ask for it.
    """
    asked = asks.groupBy(F.col("v").alias("grp")).agg(F.ceil(F.count(F.lit(1)) / GROUP_BLOCK).cast("int").alias("rounds"))
    pieces = F.ceil(F.col("weight") / GROUP_BLOCK).cast("int")
    member = groups.join(dealt(asked, "grp"), "grp").withColumn("pieces", pieces)
    members = (member.select("node", "grp", F.pmod(F.xxhash64("node"), "pieces").cast("int").alias("piece"),
                             F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)).alias("round")).join(sets, "node"))
    size = dealt(member.groupBy("grp").agg(F.max("pieces").alias("pieces"), F.max("rounds").alias("rounds")), "grp")
    asking = (asks.join(size, F.col("v") == F.col("grp")).join(sets.withColumnRenamed("node", "u"), "u")
              .select("u", "grp", "shingles", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"),
                      F.pmod(F.xxhash64("u"), "rounds").cast("int").alias("round")))
    asking = asking.toDF("u", "of", "asked", "part", "turn")  # other names than the members', which share their tables
    links = (members.groupBy("grp", "piece", "round").cogroup(asking.groupBy("of", "part", "turn"))
             .applyInArrow(_ask_block, "u bigint, v bigint"))
    return scratch.store(links, "group-links")


def near_duplicates(docs: DataFrame, region_rows: int = REGION_ROWS) -> DataFrame:
    """Group the documents (doc_id bigint, text string) whose shingle sets are linked.

    Returns doc_id, n_shingles, component_id (smallest doc_id of the group) and kept (doc_id is
    that one).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dedup")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    sketches = scratch.store(docs.mapInArrow(_sketch, SKETCH), "sketches")
    classes = scratch.store(
        sketches.where("key is not null and doc_id is not null").groupBy("key")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"),
             F.first("labels").alias("labels"), F.first("low").alias("low")), "classes")
    singles = classes.withColumns({"grp": F.col("node"), "weight": F.lit(1).cast("bigint")})
    crowded = _crowded(singles, region_rows, scratch)
    pairs = scratch.store(sweep(singles, crowded, True, region_rows), "pairs")
    scratch.tidy()
    active = scratch.store(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "active")
    sets = shingle_sets(docs, active, scratch)
    links = confirm_pairs(pairs.where("mark").select("u", "v"), sets, scratch)
    groups = scratch.store(components(links, scratch), "groups")

    known = active.join(groups, "node", "left").select("node", F.coalesce("root", "node").alias("grp"))
    weights = dealt(known.groupBy("grp").agg(F.count(F.lit(1)).alias("weight")), "grp")
    known = scratch.store(known.join(weights, "grp"), "known")
    scratch.tidy()
    asks = scratch.store(sweep(classes.join(known, "node"), crowded, False, region_rows).select("u", "v"), "asks")
    if crowded:
        # A text that no pair names has none in its thin regions, but may have some in its crowded ones.
        everyone = classes.join(known, "node", "left").withColumns(
            {"grp": F.coalesce("grp", "node"), "weight": F.coalesce("weight", F.lit(1).cast("bigint"))})
        asks = scratch.store(asks.union(sweep_crowded(everyone, crowded, scratch, region_rows)).distinct(), "all-asks")
        named = asks.select(F.explode(F.array("u", "v")).alias("node")).distinct()
        late = scratch.store(named.join(active, "node", "left_anti"), "late")
        if not late.isEmpty():
            known = known.unionByName(late.withColumns({"grp": F.col("node"), "weight": F.lit(1).cast("bigint")}))
            sets = sets.union(shingle_sets(docs, late, scratch))
    scratch.tidy()
    more = confirm_groups(asks, known, sets, scratch)
    if not more.isEmpty():
        # Every text is linked with its group already, so groups and new links together give the components.
        joined = groups.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more)
        groups = scratch.store(components(joined, scratch), "groups")
    of_class = scratch.store(classes.select("key", "node").join(groups, "node", "left")
                             .select("key", F.coalesce("root", "node").alias("root")), "class-groups")
    return (sketches.select("doc_id", "n_shingles", "key").join(of_class, "key", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")))
            .select("doc_id", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))
