"""Identifiers of learned shapes: found by contexts that the seeds teach, checked against a plain version."""

import random
import re
from collections import Counter, defaultdict
from math import exp, log

from fieldbook.llm import pii

SCHEMA = "doc_id bigint, text string"


def plain_spans(rows):
    """Spans of every document, with dictionaries instead of joins."""
    seen = [(doc, o) for doc, text in rows for o in pii.observe(text or "", pii.matches(text or ""))]
    edges = {}
    for _, o in seen:
        for kind in {o["kind"], pii.OTHER}:
            for p in o["patterns"]:
                edges[kind, p, o["value"]] = edges.get((kind, p, o["value"]), False) or o["seed"]
    score = defaultdict(float)
    for (kind, _, value), seed in edges.items():
        score[kind, value] = max(score[kind, value], float(seed))
    for _ in range(pii.ROUNDS):
        total, n, seeds = defaultdict(float), Counter(), Counter()
        for (kind, p, value), seed in edges.items():
            total[kind, p] += score[kind, value]
            n[kind, p] += 1
            seeds[kind, p] += seed
        sure = {k: total[k] / (n[k] + 0.5) for k in n}
        missed, new = defaultdict(float), defaultdict(float)
        for (kind, p, value), seed in edges.items():
            new[kind, value] = max(new[kind, value], float(seed))
            if seeds[kind, p] >= pii.SUPPORT:
                missed[kind, value] += log(1 - min(sure[kind, p], 0.999))
        score = defaultdict(float, {k: max(new[k], 1 - exp(missed[k])) for k in new})
    good = {k for k in sure if sure[k] >= pii.CONFIDENCE and seeds[k] >= pii.SUPPORT}

    def shape(value):
        return re.sub("[0-9]", "9", re.sub("[A-Za-z]", "A", value))
    hits = [(doc, o) for doc, o in seen if not o["seed"] and any((o["kind"], p) in good for p in o["patterns"])]
    inside = Counter(shape(o["value"]) for _, o in hits if o["kind"] == pii.OTHER)
    everywhere = Counter(shape(o["value"]) for _, o in seen if o["kind"] == pii.OTHER)
    out = {doc: list(pii.matches(text or "")) for doc, text in rows}
    for doc, o in hits:
        s = shape(o["value"])
        if o["kind"] != pii.OTHER or inside[s] >= max(pii.SUPPORT, pii.SHAPE * everywhere[s]):
            out[doc].append((o["start"], o["kind"], o["stop"]))
    return {doc: pii.joined(spans) for doc, spans in out.items()}


def found(spark, rows):
    return {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()}


def planted():
    rng = random.Random(4)
    word = lambda: rng.choice("river stone amber field lantern copper meadow".split())
    texts = [f"{word()} {word()} kindly contact via {word()}{k}@host.example for {word()}" for k in range(40)]
    ids = [f"AB{rng.randrange(10**6, 10**7)}" for _ in range(8)] + [f"ext-{rng.randrange(10**4, 10**5)}" for _ in range(8)]
    ids += [str(rng.randrange(10**4, 10**5)) for _ in range(8)] + [f"DE{rng.randrange(10**19, 10**20)}" for _ in range(8)]
    texts += [f"{word()} kindly contact via {i}, {word()}" for i in ids]
    # A shape that stands anywhere: some of its tokens stand in the context as well.
    common = [f"the {word()} model {rng.randrange(1000, 9999)}X was {word()}" for _ in range(60)]
    common += [f"kindly contact via {rng.randrange(1000, 9999)}X {word()}" for _ in range(6)]
    return list(enumerate(texts + common)), ids


def test_identifiers_of_other_shapes_are_found_in_learned_contexts(spark):
    rows, ids = planted()
    got = found(spark, rows)
    for doc, i in enumerate(ids, 40):
        start = rows[doc][1].index(i)
        assert got[doc].spans == f"id:{start}:{start + len(i)}"
    assert all(got[doc].spans == "" for doc in range(40 + len(ids), len(rows)))
    assert all(got[doc].n_email == 1 for doc in range(40))
    clean = {r.doc_id: r.text for r in pii.redact_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all("[ID]" in clean[doc] and i not in clean[doc] for doc, i in enumerate(ids, 40))


def test_spans_equal_a_plain_version(spark):
    rows, _ = planted()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows += [(1000 + r.doc_id, r.text) for r in docs.collect()]
    rows += [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "contact via " * 3000 + "AB1234567")]
    got, want = found(spark, rows), plain_spans(rows)
    assert {k: r.spans for k, r in got.items()} == want


def test_shapes_need_support_and_tokens_that_are_too_long_are_left(spark):
    rows = [(k, f"kindly contact via user{k}@host.example today") for k in range(30)]
    rows += [(100 + k, f"kindly contact via QQ77{k}0 today") for k in range(3)]
    rows += [(200 + k, "kindly contact via A1" + "7" * 60 + f"{k} today") for k in range(9)]
    assert all(r.spans == "" for k, r in found(spark, rows).items() if k >= 100)
