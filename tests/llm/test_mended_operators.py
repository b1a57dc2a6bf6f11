"""Main text, decontamination and WARC reading on the cases that were once lost, and against plain versions."""

import random
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import decontamination, templates, warc
from fieldbook.llm.storage import Scratch

SMALL = "/root/testdata/sf0.001"


# --- main text -----------------------------------------------------------------------------------

def extracted(spark, bodies, **extra):
    rows = [(k, f"http://h.example/p{k}", f"<html><body>{b}</body></html>") for k, b in enumerate(bodies)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for name in ("host", "page", "roots", "path", "n", "chars", "text", "template", "vector_a"):
        pages = pages.withColumn(name, F.lit(name))
    out = templates.extract_main_text(pages).orderBy("page_id").collect()
    assert all(r.n_chars == len(r.text) for r in out)
    return [r.text for r in out]


def prose(k, n=40):
    rng = random.Random(k)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n))


MENU = "<nav><a>Home</a> <a>News</a></nav><div class='ad'>Buy now</div><p class='tagline'>The paper of record</p>"
FOOT = "<footer>Imprint</footer><div class='comments'><p>nice one</p></div>"


@pytest.mark.parametrize("opens, closes", [
    ("<article id='post-{k}'>", "</article>"), ("<div id='post-{k}'>", "</div>"), ("<article>", "</article>"),
    ("<div class='entry entry-{k}'>", "</div>")])
def test_pages_whose_article_carries_its_own_id(spark, opens, closes):
    want = [prose(k) for k in range(8)]
    got = extracted(spark, [MENU + opens.format(k=k) + f"<p>{w}</p>" + closes + FOOT for k, w in enumerate(want)])
    assert got == want


def test_pages_whose_article_has_a_word_as_id(spark):
    """Without a common slot the page's text stays, but for what its host repeats and what names itself a part."""
    want = [prose(k) for k in range(8)]
    got = extracted(spark, [MENU + f"<div id='{prose(k, 1)}x'><p>{w}</p></div>" + FOOT for k, w in enumerate(want)])
    assert got == want


@pytest.mark.parametrize("section", ["id='related-work'", "class='social-history'", "class='notice-period'", "class='related'",
                                     "id='social'", "class='notice'", "role='search'"])
def test_sections_of_the_article_are_not_dropped_by_their_name(spark, section):
    want = [(prose(k, 10), prose(100 + k)) for k in range(8)]
    got = extracted(spark, [MENU + f"<article><p>{a}</p><section {section}><p>{b}</p></section></article>" + FOOT for a, b in want])
    assert got == [f"{a} {b}" for a, b in want]


def test_small_parts_inside_the_article_are_dropped_and_math_is_kept(spark):
    want = [prose(k) for k in range(8)]
    got = extracted(spark, [MENU + f"<article><p>{w} <math><mi>x</mi>=1</math></p><div class='ad'>buy {k}</div><aside>see {k}</aside>"
                            f"<form>mail {k}</form></article>" + FOOT for k, w in enumerate(want)])
    assert got == [f"{w} x=1" for w in want]


def test_an_own_article_is_not_displaced_by_the_slot_of_its_host(spark):
    """Nine pages of a host have their text in a div, the tenth in an article beside a short div."""
    want = [prose(k) for k in range(10)]
    bodies = [f"<div class='content'><p>{w}</p></div>" + FOOT for w in want[:9]]
    bodies.append(f"<div class='content'><p>see below</p></div><article><p>{want[9]}</p></article>" + FOOT)
    assert extracted(spark, bodies) == want


def test_main_text_of_very_long_pages(spark):
    want = [prose(k, 60_000 if k == 3 else 50) for k in range(6)]
    assert extracted(spark, [MENU + f"<article><p>{w}</p></article>" for w in want]) == want


class Article(HTMLParser):
    """The plain version for the given pages: the blocks of their article element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.blocks, self.run = 0, [], []

    def cut(self):
        self.blocks.append(" ".join("".join(self.run).split()))
        self.run = []

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "br", "h1", "article"):
            self.cut()
        self.depth += tag == "article"

    def handle_endtag(self, tag):
        if tag in ("p", "br", "h1", "article"):
            self.cut()
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth:
            self.run.append(data)


def test_main_text_of_the_given_pages_equals_the_plain_version(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        parser = Article()
        parser.feed(r.html or "")
        parser.close()
        parser.cut()
        want[r.page_id] = " ".join(b for b in parser.blocks if b)
    got = {r.page_id: r.text for r in templates.extract_main_text(pages).collect()}
    assert got == want


# --- decontamination -----------------------------------------------------------------------------

def leaks(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    for name in ("word", "n", "cosine", "common", "answer", "at", "weight", "part"):
        d, b = d.withColumn(name, F.lit(name)), b.withColumn(name, F.lit(name))
    return {(r.doc_id, r.item_id) for r in decontamination.find_leaks(d, b).collect()}


def vocabulary(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(4, 9))) for _ in range(n)]


@pytest.fixture(scope="module")
def leaked():
    """Documents with runs across the cuts of long items, short items among other words, and paraphrases; and clean ones."""
    rng = random.Random(17)
    words, common = vocabulary(rng, 4000), vocabulary(rng, 30)
    text = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(words) for _ in range(n)]
    items = [(k, text(n)) for k, n in enumerate([100, 150, 240, 64, 65, 35, 35, 35, 20, 20, 16, 12, 9, 9, 7, 6, 5, 5, 4, 3])]
    docs, planted = [], {}

    def plant(kind, item, run):
        planted[len(docs)] = (kind, item)
        docs.append((len(docs), " ".join(text(rng.randrange(0, 60)) + run + text(rng.randrange(0, 60)))))
    for k, own in items:
        for _ in range(6):
            if len(own) >= decontamination.MIN_WORDS:
                plant("whole", k, own)
            if len(own) >= 65:
                for n in (42, 50):
                    if len(own) >= n + 16:
                        begin = rng.randrange(len(own) - n)
                        plant("run", k, own[begin: begin + n])
            if 20 <= len(own) <= 64:
                plant("paraphrase", k, [w for w in own if rng.random() < 0.85])
    for _ in range(150):
        docs.append((len(docs), " ".join(text(rng.randrange(1, 200)))))
    return docs, [(k, " ".join(w)) for k, w in items], planted


def every_window(docs, items):
    """The plain version: each passage against every window of each document, without the latent space."""
    passages = decontamination.passages_of(items)
    out = set()
    for i, text in docs:
        own = decontamination._word_hashes(text)
        for k, words in enumerate(passages.words):
            length = decontamination.window_steps(len(words))
            for step in range(-(-len(own) // decontamination.STEP)):
                region = own[max(0, (step - 1) * decontamination.STEP): (step + length + 1) * decontamination.STEP]
                if decontamination._confirm(passages, k, region)[0]:
                    out.add((i, passages.item[k]))
                    break
    return out


def test_leaks_equal_every_window_and_find_what_is_planted(spark, leaked):
    docs, items, planted = leaked
    got, plain = leaks(spark, docs, items), every_window(docs, items)
    assert got <= plain  # nothing but what the comparison of all windows confirms
    assert len(got) >= 0.95 * len(plain)
    for kind in ("whole", "run", "paraphrase"):
        mine = {(i, k) for i, (c, k) in planted.items() if c == kind}
        assert len(mine & got) >= 0.9 * len(mine), (kind, len(mine & got), len(mine))
    verbatim = {(i, k) for i, (c, k) in planted.items() if c == "whole"}
    assert verbatim <= got
    assert {i for i, _ in got} <= set(planted)  # clean documents are left alone


def test_runs_across_cuts_and_short_items_among_other_words(spark):
    rng = random.Random(3)
    words = vocabulary(rng, 3000)
    some = lambda n: [rng.choice(words) for _ in range(n)]
    long, short = some(100), some(5)
    docs = [(1, " ".join(some(30) + long[29:71] + some(30))), (2, " ".join(some(40) + short + some(40))), (3, " ".join(short)),
            (4, " ".join(some(300))), (5, None), (6, "")] + [(10 + k, " ".join(some(100))) for k in range(40)]
    assert leaks(spark, docs, [(7, " ".join(long)), (8, " ".join(short)), (9, None), (10, "too short")]) == {(1, 7), (2, 8), (3, 8)}


def test_leaks_in_very_long_documents(spark):
    rng = random.Random(5)
    words = vocabulary(rng, 3000)
    some = lambda n: [rng.choice(words) for _ in range(n)]
    item = some(40)
    docs = [(1, " ".join(some(120_000) + item + some(90_000))), (2, " ".join(some(100_000)))]
    assert leaks(spark, docs, [(1, " ".join(item))]) == {(1, 1)}


def test_passages_overlap():
    own = np.arange(150)
    items = [(1, " ".join(f"w{k}" for k in own))]
    passages = decontamination.passages_of(items)
    hashes = decontamination._word_hashes(items[0][1])
    place = {h: k for k, h in enumerate(hashes.tolist())}
    begins = [place[w[0]] for w in passages.words.__iter__() for w in [w.tolist()]]
    assert begins[0] == 0 and begins[-1] == 150 - 64 and max(np.diff(begins)) <= decontamination.OVERLAP
    assert all(len(w) == 64 for w in passages.words)


# --- WARC ----------------------------------------------------------------------------------------

def test_archives_are_read_by_as_many_tasks(spark):
    pages = spark.range(64).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"),
                                   F.concat(F.repeat(F.lit("x"), 200), F.col("id").cast("string")).alias("html"))
    scratch = Scratch(spark, "warc-test")
    marked = pages.repartition(16).withColumns({"refers_to": F.lit(None).cast("bigint"), "same": F.lit(None).cast("string")})
    manifest = warc.write_archives(marked, f"{scratch.root}/archives", scratch)
    n = manifest.count()
    assert n >= 8
    read = warc.read_archives(manifest).withColumn("task", F.spark_partition_id())
    assert read.count() == 64 and read.select("task").distinct().count() > n // 2


def test_warc_with_clashing_columns_long_and_empty_pages(spark):
    rows = [(1, None), (2, ""), (3, "y" * 3_000_000), (4, "y" * 3_000_000), (5, "z" * 999), (6, "z" * 999), (None, "z" * 2000)]
    pages = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id bigint, url string, html string")
    for name in ("same", "keeper", "refers_to", "path", "verified", "payload", "n"):
        pages = pages.withColumn(name, F.lit(name))
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to, r.verified) for r in warc.archive_pages(pages).collect()), key=repr)
    assert got == sorted([(1, 0, "response", None, True), (2, 0, "response", None, True), (3, 3_000_000, "revisit", 4, True),
                          (4, 3_000_000, "response", None, True), (5, 999, "response", None, True),
                          (6, 999, "response", None, True), (None, 2000, "response", None, True)], key=repr)
