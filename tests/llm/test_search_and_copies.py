"""Lexical search, exact dedup and spelling variants against plain Python versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import exact_dedup, lexical_search, spelling

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
CLASH = ("n", "term", "terms", "tf", "score", "rank", "word", "run", "part", "edge", "row", "head", "mark", "text_sha256")


def table(spark, rows, key="doc_id"):
    """(doc_id, text) with columns whose names the operators use inside."""
    frame = spark.createDataFrame(rows, f"{key} bigint, text string")
    return frame.select("*", *[F.lit(c).alias(c) for c in CLASH])


# --- exact dedup ---------------------------------------------------------------------------------

def plain_groups(rows):
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    out = []
    for body, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i))
        out += [(i, ids[0], len(ids), k == 0, hashlib.sha256(body.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def groups_of(frame):
    assert frame.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, frame.collect()), key=repr)


EDGE_ROWS = [(4, "a  b"), (2, "a\tb"), (9, "a b"), (1, None), (3, ""), (7, " \n"), (8, " "), (5, "a b "), (None, "a b"),
             (None, "only"), (None, "only"), (6, "x" * 300_000), (10, "x" * 300_000), (11, "x" * 299_999 + "y"), (12, "é ü"),
             (12, "é  ü"), (12, "é ü"), (13, "a b"), (14, "a\x0bb")]


def test_exact_duplicates_edge_cases(spark):
    assert groups_of(exact_dedup.exact_duplicates(table(spark, EDGE_ROWS))) == plain_groups(EDGE_ROWS)


def test_exact_duplicates_of_an_empty_table(spark):
    assert groups_of(exact_dedup.exact_duplicates(table(spark, EDGE_ROWS).where("false"))) == []


def test_exact_duplicates_of_a_group_over_many_ranges(spark):
    """A third of the rows are equal and most share a long passage, over more ranges than a group needs."""
    rng = random.Random(5)
    passage = "the same long passage stands at the head of it " * 20
    rows = [(i, "hot text " * 3) for i in range(0, 3000, 3)]
    rows += [(i, passage + str(rng.randrange(400))) for i in range(1, 3000, 3)]
    rows += [(i, str(rng.randrange(300))) for i in range(2, 3000, 3)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "41")
    try:
        got = groups_of(exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == plain_groups(rows)


def test_runs_decide_by_the_whole_text():
    """Rows whose order keys agree are told apart by their texts, over batch borders too."""
    def batch(*rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows]),
                                           pa.array(["d"] * len(rows)), pa.array([3] * len(rows), pa.int32())],
                                          names=["doc_id", "text", "text_sha256", "part"])
    out = [r for b in exact_dedup._runs(iter([batch((1, "a"), (2, "a")), batch((3, "a")), batch((4, "b"), (5, "c"))]))
           for r in b.to_pylist()]
    assert [(r["doc_id"], r["run"], r["opens"], r["is_first"], r["is_last"], r["edge"]) for r in out] == [
        (1, 0, True, True, False, "a"), (2, 0, False, False, False, None), (3, 0, False, False, False, None),
        (4, 1, True, False, False, None), (5, 2, True, False, True, "c")]


def test_drop_exact_duplicates_keeps_columns(spark):
    kept = exact_dedup.drop_exact_duplicates(table(spark, EDGE_ROWS))
    assert kept.columns == ["doc_id", "text", *CLASH]
    want = [r[0] for r in plain_groups(EDGE_ROWS) if r[3]]
    assert sorted(r.doc_id is not None and r.doc_id for r in kept.collect()) == sorted(i is not None and i for i in want)


# --- spelling variants ---------------------------------------------------------------------------

def plain_variants(rows):
    n = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    letters = sorted({c for w in n for c in w})
    out = {}
    for w in n:
        edits = {w[:i] + w[i + 1:] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        edits |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near = sorted((e for e in edits - {w} if e in n), key=lambda e: (-n[e], e))
        form = near[0] if near and n[near[0]] >= 10 * n[w] else None
        out[w] = (form, len(near), n[form] if form else None)
    def root(w):
        while out[w][0]:
            w = out[w][0]
        return w
    return sorted(((w, f, root(w), n[w], k, fn) for w, (f, k, fn) in out.items()), key=repr)


def variants_of(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture(scope="module")
def spelled():
    """Words with their typos, chains of forms, ties, repeated letters, accents, and words above the shared shard's length."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(7, 10))) for _ in range(60)]
    words += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "Bbbbbbbb", "ÀÀÀÀÀÀÀÀ", "÷×ÿýüûúù", "z" * 63 + "q", "z" * 64, "z" * 65 + "q", "z" * 66]
    rows = []
    for i in range(900):
        text = []
        for _ in range(12):
            w = words[min(int(rng.expovariate(0.12)), len(words) - 1)]
            if rng.random() < 0.15:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "b", "é", "a" + w[at]]) + w[at + 1:]
            text.append(w)
        rows.append((i, " ".join(text)))
    chain = [("shortest", 2), ("shortestx", 20), ("shortestxy", 200), ("shortextxy", 2000)]
    rows += [(None, " ".join([w] * k)) for w, k in chain]
    return rows + [(1, None), (2, ""), (3, "1234567 short 89"), (4, "w" * 5000 + " " + "w" * 5000 + " " + "w" * 4999), (4, "w" * 4999)]


def test_spelling_variants_equal_brute_force(spark, spelled):
    got = variants_of(spelling.spelling_variants(table(spark, spelled)))
    assert got == plain_variants(spelled)
    assert any(r[2] != r[1] and r[1] for r in got) and any(r[4] > 5 for r in got)


def test_spelling_variants_in_many_windows(spark, spelled, monkeypatch):
    """A filter broadcast in windows, smaller than a shard, gives the same."""
    monkeypatch.setattr(spelling, "CHUNK", 16)
    monkeypatch.setattr(spelling, "PROBES", 500)
    got = variants_of(spelling.spelling_variants(table(spark, spelled), window_bytes=16 * 8 * 5))
    assert got == plain_variants(spelled)


def test_spelling_variants_of_empty_tables(spark, spelled):
    assert variants_of(spelling.spelling_variants(table(spark, spelled).where("false"))) == []
    assert variants_of(spelling.spelling_variants(table(spark, [(1, None), (2, "few short words")]))) == []


def test_filter_has_every_word():
    """No word of the vocabulary is missed, and few others pass."""
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcdefghij") for _ in range(rng.randrange(7, 14))) for _ in range(4000)})
    others = sorted({"".join(rng.choice("klmnop") for _ in range(9)) for _ in range(4000)})
    shards = spelling._Shards(collections.Counter(map(len, words)))
    held = np.zeros(shards.total, np.uint64)
    def places(some):
        for length, _, code in spelling._by_length(some):
            yield shards.place((code * spelling._powers(length)).sum(axis=1, dtype=np.uint64), length)
    for block, bits in places(words):
        np.bitwise_or.at(held, block, bits)
    assert all(((held[block] & bits) == bits).all() for block, bits in places(words))
    assert sum(((held[block] & bits) == bits).sum() for block, bits in places(others)) < 0.02 * len(others)


# --- lexical search ------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, k=10):
    tf = [(i, collections.Counter(TERM.findall((t or "").translate(UPPER)))) for i, t in docs]
    tf = [(i, c) for i, c in tf if c]
    n_docs, all_terms = len(tf), sum(sum(c.values()) for _, c in tf)
    df = collections.Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in tf:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // all_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(TERM.findall((text or "").translate(UPPER))) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def found(frame):
    assert [f.simpleString() for f in frame.schema] == ["item_id:bigint", "rank:int", "doc_id:bigint", "score:bigint"]
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)] + ["é", "ÉÉ", "straße", "日本", "A1b2"]
    pick = lambda n: " ".join(words[min(int(rng.expovariate(0.02)), len(words) - 1)] for _ in range(n))
    docs = [(i, pick(rng.randrange(1, 60))) for i in range(700)]
    docs += [(700 + i, docs[i][1]) for i in range(60)]  # ties
    docs += [(5, docs[5][1]), (None, docs[6][1]), (None, docs[6][1]), (900, None), (901, ""), (902, " .,;\n"),
             (903, "w1 " * 40000 + "W2"), (904, "W3{w4}w5_w6`w7^w8/w9:w10@w11[w12]")]
    items = [(i, pick(rng.randrange(1, 40))) for i in range(30)]
    items += [(100, None), (101, "..."), (102, "unknownterm"), (103, docs[7][1]), (103, docs[8][1]), (104, "w1 " * 3000), (None, "w299 é 日本")]
    return docs, items


def test_search_equals_brute_force(spark, corpus):
    docs, items = corpus
    got = found(lexical_search.search(table(spark, docs), table(spark, items, "item_id")))
    assert got == plain_search(docs, items)


def test_search_in_blocks_and_chunks(spark, corpus, monkeypatch):
    """Several blocks of items, several chunks a task and short reads give the same."""
    docs, items = corpus
    for name, value in (("CHUNK_DOCS", 50), ("CHUNK_POSTINGS", 300), ("READ", 2), ("TEXT_BYTES", 500)):
        monkeypatch.setattr(lexical_search, name, value)
    got = found(lexical_search.search(table(spark, docs).repartition(3), table(spark, items, "item_id"), k=4, item_bytes=1000))
    assert got == plain_search(docs, items, 4)


def test_search_of_empty_tables(spark, corpus):
    docs, items = corpus
    d, i = table(spark, docs), table(spark, items, "item_id")
    assert found(lexical_search.search(d.where("false"), i)) == []
    assert found(lexical_search.search(d, i.where("false"))) == []
    assert found(lexical_search.search(table(spark, [(1, None), (2, "..")]), i)) == []


def test_best_positions_stop_early_and_are_exact():
    """The bound at the best positions stops long before the lists end; ties at the kth place are still right."""
    rng = np.random.default_rng(2)
    doc, term, impact = [], [], []
    for t in range(4):
        own = rng.permutation(20000)[:15000]
        doc.append(own)
        term.append(np.full(15000, t))
        impact.append((1000 / (1 + np.arange(15000) / 20)).astype(np.int64) + 1)
    doc, term, impact = map(np.concatenate, (doc, term, impact))
    lists = lexical_search.ImpactLists(doc, term, impact)
    best, ids = lexical_search.Best(), np.arange(20000)[::-1].copy()
    read = lexical_search.best_positions(lists, np.arange(4), ids, np.zeros(20000, bool), best, 10)
    total = np.bincount(doc, weights=impact, minlength=20000).astype(np.int64)
    order = np.lexsort((ids, -total))[:10]
    assert list(zip(best.score, best.doc_id, strict=True)) == list(zip(total[order], ids[order], strict=True))
    assert read < 0.5 * len(doc)


def test_hash_tells_block_positions_apart():
    """A term has the same hash wherever it stands."""
    column = pa.array(["aa bb aa", None, "", "xaa AA-bb", "bb"])
    for size in (1, 1 << 20):
        lexical_search.TEXT_BYTES, old = size, lexical_search.TEXT_BYTES
        try:
            spans = [(first + r, bytes(t.data[s:e]).decode(), h) for first, _, t in lexical_search.terms(column)
                     for r, s, e, h in zip(t.row, t.start, t.end, t.hash, strict=True)]
        finally:
            lexical_search.TEXT_BYTES = old
        assert [(r, w) for r, w, _ in spans] == [(0, "aa"), (0, "bb"), (0, "aa"), (3, "xaa"), (3, "aa"), (3, "bb"), (4, "bb")]
        assert len({(w, h) for _, w, h in spans}) == len({h for _, _, h in spans}) == 3
