"""The llm operators on small tables: brute-force results and defined edge cases."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from fieldbook.llm import (decontamination, mixing, near_dedup, ngram_model, pii, quality_classifier, quality_rules,
                           secret_scan, templates, warc)
from fieldbook.llm.elias_fano import EliasFano, Levels

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return WORD.findall((text or "").encode().lower())


def table(spark, rows):
    """documents with columns whose names the operators use inside."""
    frame = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)
    for name in ("node", "key", "rank", "row", "score", "shard", "held", "found", "digest"):
        from pyspark.sql import functions as F
        frame = frame.withColumn(name, F.lit(name))
    return frame


EDGE = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (None, "one two three four five six seven eight nine ten eleven", "b"),
        (4, "one two three", "b"), (5, "one two three", "b"), (5, "one two three", "b"),
        (6, "x " * 30000 + "tail", "c"), (7, "é" * 5000 + " ü # $ 12", "c")]


@pytest.fixture(scope="module")
def edge(spark):
    return table(spark, EDGE)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, EDGE).where("false")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


def test_near_duplicates_equal_brute_force(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    sets = {}
    for r in docs.select("doc_id", "text").collect():
        w = words(r.text)
        sets[r.doc_id] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    assert got == {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_near_duplicates_in_crowded_regions(spark):
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in rng.integers(0, 10**6, 80)]
    rows = []
    for k in range(120):
        own = list(base)
        own[int(rng.integers(80))] = f"v{k}"
        rows.append((k, " ".join(own), "s"))
    got = near_dedup.near_duplicates(table(spark, rows), region_rows=8).collect()
    assert {r.component_id for r in got} == {0}


def test_near_duplicates_sole_links_in_crowded_regions(spark):
    """Texts with a single link, among texts that crowd the regions of every tree."""
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(60):
        first = list(base)
        for at in 6 * rng.choice(50, 5, replace=False):
            first[at] = f"a{k}_{at}"
        second = list(first)
        for at in 6 * rng.choice(50, 8, replace=False) + 3:
            second[at] = f"b{k}_{at}"
        rows += [(k, " ".join(first), "s"), (1000 + k, " ".join(second), "s")]
    sets = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, t, _ in rows for w in [t.split()]}
    alike = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    root = {i: i for i in sets}
    for (a, b), part in alike.items():
        if part >= 0.75:
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = {i: new if r == old else r for i, r in root.items()}
    assert all(sum(part >= 0.75 for pair, part in alike.items() if 1000 + k in pair) == 1 for k in range(60))
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table(spark, rows), region_rows=4).collect()}
    assert got == root


def test_near_duplicates_edges(edge, empty):
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(edge).collect()]
    assert sorted(got, key=str) == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (None, 7, None, True), (4, 1, 4, True),
                                           (5, 1, 4, False), (5, 1, 4, False), (6, 2, 6, True), (7, 1, 7, True)], key=str)
    assert near_dedup.near_duplicates(empty).collect() == []


def test_elias_fano_round_trip():
    rng = np.random.default_rng(1)
    for values in (np.zeros(0, np.uint64), np.array([5], np.uint64), np.sort(rng.integers(0, 2**62, 3000).astype(np.uint64)),
                   np.sort(rng.integers(0, 50, 500).astype(np.uint64))):
        levels = Levels()
        coded = EliasFano(levels, values)
        levels.seal()
        assert np.array_equal(coded.access(np.arange(len(values))), values)
        asked = np.append(values, values + np.uint64(1))
        found = coded.search(np.zeros(len(asked), np.int64), np.full(len(asked), len(values)), asked)
        assert np.array_equal(found, np.searchsorted(values, asked))


def plain_ngram_scores(rows):
    """Rows (doc_id, text) under the three-word model, in plain Python and without quantised probabilities."""
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}

    def triples(text):
        w = [b" ", b" ", *words(text), b"\n"]
        return list(zip(w, w[1:], w[2:]))
    one, two, three, c1, c2 = (collections.Counter() for _ in range(5))
    for i, text in rows:
        if not held[i]:
            for u, v, w in triples(text):
                one[w] += 1
                two[v, w] += 1
                three[u, v, w] += 1
                c1[v] += 1
                c2[u, v] += 1
    n1, n2 = collections.Counter(v for v, _ in two), collections.Counter((u, v) for u, v, _ in three)
    total, distinct = sum(one.values()), len(one)
    out = []
    for i, text in rows:
        base = score = known = 0
        for u, v, w in triples(text):
            p = (one[w] + 0.1) / (total + 0.1 * (distinct + 1))
            base, known = base + math.log10(p), known + (one[w] > 0)
            if c1[v]:
                p = max(two[v, w] - 0.75, 0) / c1[v] + 0.75 * n1[v] / c1[v] * p
            if c2[u, v]:
                p = max(three[u, v, w] - 0.75, 0) / c2[u, v] + 0.75 * n2[u, v] / c2[u, v] * p
            score += math.log10(p)
        out.append((i, held[i], len(words(text)) + 1, known, total, base, score))
    return out


def assert_ngram_scores(frame, rows, **options):
    want = sorted(plain_ngram_scores(rows), key=lambda r: (str(r[0]), r[2], r[6]))
    got = sorted((tuple(r) for r in ngram_model.score_documents(frame, **options).collect()), key=lambda r: (str(r[0]), r[2], r[6]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5])
        assert abs(g[6] - w[6]) / w[2] <= 0.0201  # half a step of the stored byte per token


def test_ngram_scores_equal_a_plain_model(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert_ngram_scores(docs, rows, shard_tokens=1 << 20)
    # A shard of 300 tokens: hot words, hot pairs and rare words whose counts are asked for.
    assert_ngram_scores(docs, rows, shard_tokens=300, common=20)


def test_ngram_hot_triples_and_repeated_words(spark):
    rows = [(k, f"terms of use apply here w{k} terms of use apply " + "so " * (k % 9)) for k in range(400)]
    rows += [(1000, "so " * 3000), (None, "terms of use"), (1001, None)]
    assert_ngram_scores(table(spark, [(i, t, "a") for i, t in rows]).repartition(3), rows, shard_tokens=200, common=3)


def test_ngram_scores_with_more_words_than_are_broadcast(spark):
    rng = np.random.default_rng(5)
    drawn = rng.zipf(1.15, 420000) % 400009
    assert len(np.unique(drawn)) > 1 << 16
    rows = [(k, " ".join(f"w{x}" for x in part)) for k, part in enumerate(np.array_split(drawn, 600))]
    assert_ngram_scores(table(spark, [(i, t, "a") for i, t in rows]), rows, shard_tokens=1 << 16, common=1 << 12)


def test_ngram_edges(edge, empty):
    got = [(r.doc_id, r.n_tokens) for r in ngram_model.score_documents(edge, shard_tokens=5000).collect()]
    assert sorted(got, key=str) == sorted([(i, len(words(t)) + 1) for i, t, _ in EDGE], key=str)
    assert ngram_model.score_documents(empty).collect() == []


def test_classifier_on_held_out_rows(docs, labels):
    scored = quality_classifier.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum((r.score >= 0.5) == (r.quality == 1) for r in scored)
    assert right >= 0.85 * len(scored) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)


def test_classifier_edges(edge, empty, labels):
    assert len(quality_classifier.classify(edge, labels).collect()) == len(EDGE)
    assert {r.score for r in quality_classifier.classify(edge, labels.where("false")).collect()} == {0.5}
    assert quality_classifier.classify(empty, labels).collect() == []


HTML = ("<html><head><title>t</title><script>var a='<p>';</script></head><body><nav><ul><li><a href='x'>menu {n}</a></ul></nav>"
        "<div class=\"ad\">buy {n}</div><article><h1>Head {n}</h1><p>A &amp; B<br>c<p>second <b>bo</b>ld{n}"
        "<div class='comments'>reader {n}</div></article><footer>&copy; host</footer></body></html>")
PAGES = "page_id bigint, url string, html string"


def test_main_text(spark):
    rows = [(n, f"http://a.example/{n}", HTML.replace("{n}", str(n))) for n in range(6)]
    rows += [(10, None, None), (11, "x", ""), (12, "http://b.example/", "<p>only &lt;text&gt;"), (12, "http://b.example/", "<p>only &lt;text&gt;"),
             (13, "http://a.example/q", HTML[:230])]
    got = [(r.page_id, r.text, r.n_chars) for r in templates.extract_main_text(spark.createDataFrame(rows, PAGES)).collect()]
    want = [(n, f"Head {n} A & B c second bold{n}") for n in range(6)] + [(10, ""), (11, ""), (12, "only <text>"), (12, "only <text>")]
    assert sorted(g for g in got if g[0] != 13) == sorted((i, t, len(t)) for i, t in want)
    assert templates.extract_main_text(spark.createDataFrame([], PAGES)).collect() == []


def test_main_text_without_article(spark):
    page = "<body><div id='top'>same line</div><div id='story'><p>{t}</p></div><aside>more</aside></body>"
    rows = [(n, f"http://h.example/{n}", page.replace("{t}", f"long story number {n} " * 5)) for n in range(8)]
    got = templates.extract_main_text(spark.createDataFrame(rows, PAGES)).collect()
    assert all(r.text == " ".join(["long story number", str(r.page_id)] * 5) for r in got)


def test_mix_edges(edge, empty):
    got = mixing.systematic_mix(edge).collect()
    assert len(got) == len(EDGE) and all(0 <= r.copies <= 2 and r.taken == r.copies * r.size for r in got)
    sizes = {s: r.source_size for r in got for s in [r.source]}
    assert sum({r.source: r.target for r in got}.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine)
    assert mixing.systematic_mix(empty).collect() == []
    assert mixing.emit_mix(edge).count() == sum(r.copies for r in got)


def test_secret_layers():
    import base64
    import gzip
    from urllib.parse import quote

    secret = "token = AKIA" + "ABCDEFGHIJ123456"
    zipped = base64.b64encode(gzip.compress(secret.encode())).decode()
    twice = quote(quote("password=abcdefghijkl", safe=""), safe="")
    text = f"say é {zipped} and {twice} hex 0123456789abcdef0 \\u0074oken=abcdefghijklmno"
    base, more, unopened = secret_scan.scan(text)
    assert base == [(text.index("0123"), 2, text.index("0123") + 17)] or (text.index("0123"), 2, text.index("0123") + 17) in base
    at = text.index(zipped)
    assert (at, 0, at + len(zipped)) in more and (at, 1, at + len(zipped)) in more and unopened == 0
    assert any(k == 0 and text[a:b].startswith("password") for a, k, b in more)
    assert any(k == 0 and text[a:b].startswith("\\u0074oken") for a, k, b in more)


def test_secret_layers_at_every_position():
    import base64

    plain = "password=abcdefghijkl"
    for piece in (base64.b64encode(plain.encode()).decode(), "%70assword=abcdefghijkl", "\\u0070assword=abcdefghijkl"):
        text = f"{piece} and again\n{piece}\nand {piece}"
        want = [(m.start(), 0, m.end()) for m in re.finditer(re.escape(piece), text)]
        base, more, _ = secret_scan.scan(text)
        assert len(want) == 3 and set(want) <= set(base + more)
    inner = base64.b64encode(plain.encode()).decode()
    outer = base64.b64encode(f"see {inner} there".encode()).decode()
    text = f"{outer} {inner} {outer}"
    assert [(a, b) for a, k, b in secret_scan.scan(text)[1] if k == 0] == [m.span() for m in re.finditer(r"\S+", text)]


def test_secret_escapes_beside_plain_words():
    for text in ("password: hunter%32abcdefghij", "\\u0070assword = hunter2abcdefgh", "pass%77ord: abcdefghijklmnop",
                 "&#112;assword = hunter2abc%64efgh"):
        base, more, _ = secret_scan.scan(text)
        assert (0, 0, len(text)) in base + more


def test_secret_wrapped_base64_and_members():
    import base64
    import gzip

    rng = np.random.default_rng(2)
    filler = " ".join(f"w{k}" for k in rng.integers(0, 10**6, 60))
    secret = "password = abcdefghijkl"
    zipped = gzip.compress(filler.encode()) + gzip.compress(f"{filler}\n{secret}".encode())
    lines = base64.encodebytes(zipped).decode().strip()
    for text in (f"data:\n{lines}\n\nend", f"data: {lines}\nThe end", lines.replace("\n", "\r\n  ")):
        assert any(k == 0 for _, k, _ in secret_scan.scan(text)[1])
    piece = base64.b64encode(gzip.compress(b"#\n" * 17_000_000 + secret.encode())).decode()
    assert secret_scan.scan(f"see {piece} there")[1] == [(4, 0, 4 + len(piece))]
    assert secret_scan.scan(base64.b64encode(gzip.compress(bytes(40 << 20))).decode())[1] == []


def test_secret_base_and_edges(edge, empty):
    for text in ("API_KEY: 'abc.def-ghi_12' token=short secret: token: abcdefghijklmnop", "AKIA0123456789ABCD AKIAX", "f" * 40 + "g" + "0" * 15):
        want = [(m.start(), 0, m.end()) for m in secret_scan.ASSIGN.finditer(text) if len(m.group(2)) >= 12]
        want += [(m.start(), 1, m.end()) for m in secret_scan.ACCESS.finditer(text) if len(m.group()) >= 18]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
        assert secret_scan.matches(text) == sorted(want)
    got = secret_scan.scan_secrets(edge).collect()
    assert len(got) == len(EDGE) and got[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert secret_scan.scan_secrets(empty).collect() == []


def test_personal_data_base():
    text = "a@b@c.de x..y%+@host.example.com, 1.2.3.4.5 999.1.1.1; 4111 1111-1111 1111 +1 (555) 555-0100. +1 2"
    email = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ip = [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) < 256 for x in m.group().split("."))]
    got = pii.matches(text)
    assert [s for s in got if s[1] < 2] == sorted(email + ip)
    assert [text[a:b] for a, k, b in got if k == 2] == ["4111 1111-1111 1111"]
    assert [text[a:b] for a, k, b in got if k == 3] == ["+1 (555) 555-0100"]
    assert pii.matches("a" * 200000 + "@" + "1" * 200000) == []


def test_contextual_identifiers(spark, empty):
    seeds = [(n, f"please call +1 555 010 {1000 + n} today or never", "s") for n in range(40)]
    unseen = [(100, "please call 5550109999 today or never", "s"), (101, "room 5550109999 is free", "s"), (102, None, "s")]
    got = {r.doc_id: r for r in pii.find_personal_data(table(spark, seeds + unseen)).collect()}
    assert got[100].spans == "phone:12:22" and got[100].n_phone == 0 and got[101].spans == "" and got[102].spans == ""
    clean = {r.doc_id: r.text for r in pii.redact_documents(table(spark, seeds + unseen)).collect()}
    assert clean[100] == "please call [PHONE] today or never" and clean[101] == "room 5550109999 is free" and clean[102] is None
    assert pii.find_personal_data(empty).collect() == []


def test_contextual_identifiers_with_blanks(spark):
    seeds = [(n, f"please call +1 555 010 {1000 + n} today or never", "s") for n in range(40)]
    unseen = [(100, "please call 020 7946 0958 today or never", "s"), (101, "please call (030) 123 4567 today or never", "s"),
              (102, "rooms 020 7946 0958 are free", "s")]
    clean = {r.doc_id: r.text for r in pii.redact_documents(table(spark, seeds + unseen)).collect()}
    assert clean[100] == clean[101] == "please call [PHONE] today or never" and clean[102] == "rooms 020 7946 0958 are free"


def test_quality_statistics_equal_brute_force(docs, edge):
    for frame in (docs, edge):
        texts = frame.select("doc_id", "text").collect()
        got = collections.Counter(tuple(r)[:6] for r in quality_rules.statistics(frame).collect())
        want = collections.Counter()
        for r in texts:
            w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
            n = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
            covered = {j for k in range(len(w) - 4) if n[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
            lines = [x for x in (r.text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            want[(r.doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r.text or "")), len(lines) - len(set(lines)), len(covered))] += 1
        assert got == want


def test_quality_rules_edges(edge, empty, labels):
    got = {r.doc_id: r for r in quality_rules.apply_quality_rules(edge, labels.where("false")).collect()}
    assert got[1].base_failed and not got[1].kept and got[6].base_failed and got[None].kept
    assert quality_rules.apply_quality_rules(empty, labels).collect() == []


def test_warc_round_trip(spark):
    big = "é<p>" * 400
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (2, "http://a/2", big), (None, None, big), (3, "http://a b/\r\n", "small"),
            (4, "u", "small"), (5, "u", None)]
    got = warc.archive_pages(spark.createDataFrame(rows, PAGES)).collect()
    sha = hashlib.sha1(big.encode()).hexdigest()
    want = [(1, 2000, sha, "revisit", 2), (2, 2000, sha, "response", None), (2, 2000, sha, "response", None), (None, 2000, sha, "revisit", 2),
            *((n, 5, hashlib.sha1(b"small").hexdigest(), "response", None) for n in (3, 4)), (5, 0, hashlib.sha1(b"").hexdigest(), "response", None)]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str) and all(r.verified for r in got)
    assert warc.archive_pages(spark.createDataFrame([], PAGES)).collect() == []


def test_leaks(spark, docs, empty):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = {r.item_id: words(r.text) for r in bench.collect()}
    want = set()
    for r in docs.collect():
        text = b" ".join(words(r.text))
        want |= {(r.doc_id, i) for i, w in items.items() if b" ".join(w) in text}
    found = decontamination.find_leaks(docs, bench).collect()
    assert want <= {(r.doc_id, r.item_id) for r in found}
    assert all(r.common >= 0.45 * r.passage_words for r in found)
    assert docs.count() - decontamination.drop_leaks(docs, bench).count() == len({r.doc_id for r in found})
    assert decontamination.find_leaks(empty, bench).collect() == []
    assert decontamination.find_leaks(docs, bench.where("false")).collect() == []


def test_leaks_of_paraphrases(spark, docs):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    item = max(bench.collect(), key=lambda r: len(r.text))
    w = item.text.split()
    changed = " ".join(f"zz{k}" if k % 5 == 2 else x for k, x in enumerate(w))
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(10**6, "unseen opening words here " + changed + " and an end"), (None, None)],
                                                                      "doc_id bigint, text string"))
    assert (10**6, item.item_id) in {(r.doc_id, r.item_id) for r in decontamination.find_leaks(more, bench).collect()}


def test_pipeline_stages(spark, docs):
    import corpus_pipeline

    from fieldbook.llm.storage import Scratch
    scratch, current = Scratch(spark, "test"), docs
    for name, stage in corpus_pipeline.STAGES:
        before = current.count()
        current = scratch.store(stage(spark, current, SMALL), name.replace(" ", "-"))
        if name != "mix":
            assert current.columns == docs.columns and current.count() <= before
    assert set(docs.columns) < set(current.columns)
    blank = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, blank, SMALL).count() == 0
