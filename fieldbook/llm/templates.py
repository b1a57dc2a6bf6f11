"""Operator 4: main text by equivalence-class template deduction.

The tokens of a page are its elements, told apart by their path of ancestors.  Over the
pages of a host every token has an occurrence vector, how often it stands on each page.
Spark sums a fingerprint of that vector per (host, token), so tokens with equal vectors,
an equivalence class, are found without gathering a host's pages.  Large and frequent
classes whose tokens nest are the host's template.  The article slot is the template
element that holds the article; what the template places elsewhere (menus, headers,
footers, adverts, forms, comments, constant text) is left out, and the text that
remains in the slot is extracted from each page in page order.

Per host only tokens on at least ``FREQUENT`` of its pages are brought together; a page
with m tokens allows at most m / FREQUENT of them, whatever the number of pages.

Inside the article a name alone decides little.  An element below the slot is left out if HTML itself says that it
is no text of the article (navigation, aside, form, script), or if one of its class, id or role words is exactly that of a
page part and the article keeps most of its text without such elements.  Names with such a word inside (related-work,
social-history) are part of the article.  Paths do not depend on digits in class and id values, so that pages whose
elements carry their own number still share a template.

Edge cases.  Texts of any length are read whole, a page at a time.  A null or blank html gives an empty text.  A page of a host without a template,
or without the template's article slot, falls back to its own article or main element, then to its
body.  Null urls share one host.  Truncated pages end where they end.  Repeated rows are
separate pages.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.storage import Scratch

FREQUENT = 0.05
MIN_PAGES = 3
MIN_CLASS = 3
# Element names of HTML by what they do, and words that name page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object select button".split())
DROPPED = frozenset("nav footer aside form header dialog menu".split()) | RAW
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section "
                   "summary table tbody td tfoot th thead title tr ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
PARTS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent "
                  "disclaimer footer header menu modal nav navbar navigation newsletter notice notices pagination pager popup "
                  "promo promotion recommended related reply replies respond share sharing sidebar signup social sponsor sponsored "
                  "subscribe toolbar widget complementary contentinfo search".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</?[a-zA-Z][^<>]*\Z", re.S)
_ATTR = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_DIGITS = re.compile(r"\d+")
_SCHEMA = "host string, path string, page bigint, n int, chars bigint, text_hash bigint"
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Piece(NamedTuple):
    """Text of one run inside an element.

    ``dropped`` where an ancestor is no article part by its element; ``named`` is the outermost ancestor whose name says
    so, and ``exact`` whether some ancestor's name is exactly that of a part.
    """

    path: str
    text: str
    dropped: bool
    named: str | None
    exact: bool


class Page(NamedTuple):
    elements: list[str]
    pieces: list[Piece | None]  # None: a block ends


def _named_parts(attrs: str) -> tuple[str, bool, bool]:
    """Suffix of the path token; whether a name holds the word of a page part, and whether it is exactly one."""
    suffix, holds, exact = "", False, False
    for key, value in _ATTR.findall(attrs):
        value = value.strip("\"'").lower()
        suffix += f"[{key.lower()}={_DIGITS.sub('', value)}]"
        if key.lower() != "itemprop":
            holds = holds or any(w in PARTS for w in re.split(r"[^a-z]+", value))
            exact = exact or any(w in PARTS for w in value.split())
    return suffix, holds, exact


def walk(source: str) -> Page:
    """Elements and text runs of a page, with the end tags that HTML lets pages leave out."""
    elements: list[str] = []
    pieces: list[Piece | None] = []
    stack: list[tuple[str, str, bool, str | None, bool]] = [("", "", False, None, False)]
    at, size = 0, len(source)

    def text(upto):
        if upto > at:
            _, path, *says = stack[-1]
            pieces.append(Piece(path, entities.unescape(source[at:upto]), *says))

    def pop_to(names, stop):
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                del stack[k:]
                return True
            if stack[k][0] in stop:
                return False
        return False

    while at < size:
        m = _TOKEN.search(source, at)
        if not m:
            text(size)
            break
        text(m.start())
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            pieces.append(None)
        if m["close"]:
            if name in BLOCKS or name not in VOID:
                pop_to({name}, ())
            continue
        if name in BLOCKS and name != "br":
            pop_to({"p"}, {"article", "body", "div", "section", "main", "td", "li", "blockquote"})
        if name in CLOSES:
            pop_to(CLOSES[name], {"ul", "ol", "dl", "table", "select", "menu"})
        suffix, holds, exact = _named_parts(m["attrs"]) if m["attrs"] else ("", False, False)
        _, parent, dropped, named, exactly = stack[-1]
        path = f"{parent}/{name}{suffix}"
        inside = re.search(r"/(article|main)\b", parent)
        out = dropped or (name in DROPPED and not (name == "header" and inside))
        if holds and name not in ("html", "body", "article", "main"):
            named, exactly = named or path, exactly or exact
        if name in VOID:
            continue
        if name in BLOCKS or name in RAW or suffix:
            elements.append(path)
            if name in RAW and not m["attrs"].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                at = end.end() if end else size
                continue
            stack.append((name, path, out, named, exactly))
    return Page(elements, pieces)


def slot_text(page: Page, roots: list[str], constant: set[str]) -> str:
    """Kept text below any of ``roots``, blocks in order joined by a space; the whole page where there is no root."""
    def kept(piece: Piece) -> bool:
        if piece.dropped or piece.path in constant or (roots and not _below(piece.path, roots)):
            return False
        return piece.named is None or (_inside(piece.named, roots) and (by_name or not piece.exact))

    # Elements with the name of a part go, unless they hold most of the article.
    by_name = False
    if roots:
        lean = sum(len(p.text) for p in page.pieces if p and kept(p))
        by_name = True
        by_name = 2 * lean < sum(len(p.text) for p in page.pieces if p and kept(p))
    blocks, run = [], []
    for piece in [*page.pieces, None]:
        if piece is None:
            block = " ".join("".join(run).split())
            if block:
                blocks.append(block)
            run = []
        elif kept(piece):
            run.append(piece.text)
    return " ".join(blocks)


def _below(path: str, roots: list[str]) -> bool:
    return any(path == r or path.startswith(r + "/") for r in roots)


def _inside(path: str, roots: list[str]) -> bool:
    """Whether an element lies in one of ``roots`` (or bears its name); a part around a root is outside."""
    return any(path.startswith(r + "/") or path == r for r in roots)


def _is_article(path: str) -> int:
    last = path.rsplit("/", 1)[-1]
    if last.startswith("article") or "[itemprop=articlebody]" in last:
        return 2
    return 1 if last.startswith("main") or "[role=main]" in last else 0


def _own_roots(elements: list[str]) -> list[str]:
    best = max(map(_is_article, elements), default=0)
    return sorted({p for p in elements if best and _is_article(p) == best})


def _number(data: str) -> int:
    return int.from_bytes(hashlib.blake2b(data.encode(), digest_size=8).digest(), "big", signed=True)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths, pages, ns, chars, hashes = [], [], [], [], [], []
        for host, key, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            page = walk(source or "")
            texts: dict[str, list[str]] = {}
            for piece in page.pieces:
                if piece and not piece.dropped and piece.named is None and not piece.text.isspace():
                    texts.setdefault(piece.path, []).append(piece.text)
            for path, n in Counter(page.elements).items():
                own = " ".join(" ".join(texts.get(path, [])).split())
                hosts.append(host)
                paths.append(path)
                pages.append(key)
                ns.append(n)
                chars.append(len(own))
                hashes.append(_number(own))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(pages, pa.int64()), pa.array(ns, pa.int32()),
             pa.array(chars, pa.int64()), pa.array(hashes, pa.int64())], names=["host", "path", "page", "n", "chars", "text_hash"])


def equivalence_classes(paths: pd.DataFrame, host_pages: int) -> list[list[str]]:
    """Classes of paths with equal occurrence vectors: large, frequent and nested one in the other, largest first."""
    classes = []
    for (_, _, pages, _), rows in paths.groupby(["vector_a", "vector_b", "pages", "total"]):
        if pages * 2 >= host_pages and pages >= MIN_PAGES:
            own = sorted(rows["path"], key=lambda p: p.count("/"))
            if len(own) >= MIN_CLASS or any(_is_article(p) for p in own):
                classes.append((int(pages), own))
    valid: list[tuple[int, list[str]]] = []
    for pages, own in sorted(classes, key=lambda c: (-c[0], -len(c[1]), c[1])):
        known = [p for _, c in valid for p in c]
        parents = {_nearest(p, known) for p in own if _nearest(p, known) not in own}
        if not valid or all(x is not None for x in parents):
            valid.append((pages, own))
    return [own for _, own in valid]


def _nearest(path: str, known: list[str]) -> str | None:
    above = [k for k in known if path.startswith(k + "/")]
    return max(above, key=len, default=None)


def _deduce(paths: pd.DataFrame) -> pd.DataFrame:
    host, pages = paths["host"].iloc[0], int(paths["host_pages"].iloc[0])
    classes = equivalence_classes(paths, pages)
    template = [p for c in classes for p in c]
    roots = _own_roots(template)
    if not roots:
        # All text of the host counts, that of elements which stand on few pages too.
        total, held = paths["host_chars"].iloc[0], dict.fromkeys(template, 0)
        for path, chars in zip(paths["path"], paths["chars"], strict=True):
            for at in [m.start() for m in re.finditer("/", path)][1:] + [len(path)]:
                if path[:at] in held:
                    held[path[:at]] += chars
        deep = [p for p in template if total and held[p] >= 0.7 * total]
        roots = [max(deep, key=len)] if deep else []
    fixed = paths[(paths["same_text"]) & (paths["chars"] > 0) & (paths["pages"] >= max(MIN_PAGES, 0.5 * pages))]["path"]
    constant = [p for p in fixed if not any(_is_article(r) and _below(p, [r]) for r in roots)]
    return pd.DataFrame({"host": [host], "roots": [roots], "constant": [constant]})


def host_of(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _HOST, 1))


def deduce_templates(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, roots, constant) for the hosts of pages (host, page, html)."""
    seen = pages.select("host", "page", "html").mapInArrow(_occurrences, _SCHEMA)
    tokens = scratch.store(seen.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("n").alias("total"), F.sum("chars").alias("chars"),
        F.bit_xor(F.xxhash64("page", "n")).alias("vector_a"), F.bit_xor(F.xxhash64("n", "page", F.lit(7))).alias("vector_b"),
        (F.min("text_hash") == F.max("text_hash")).alias("same_text")), "tokens")
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    texts = tokens.groupBy("host").agg(F.sum("chars").alias("host_chars"))
    frequent = (tokens.join(sizes, "host").join(texts, "host").where(
        (F.col("pages") >= MIN_PAGES) & (F.col("pages") >= FREQUENT * F.col("host_pages"))))
    return scratch.store(frequent.groupBy("host").applyInPandas(
        _deduce, "host string, roots array<string>, constant array<string>"), "templates")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, roots, constant in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
            page = walk(source or "")
            here, own = [r for r in roots or [] if r in page.elements], _own_roots(page.elements)
            if own and not set(here) & set(own):
                here = own  # the template's slot never stands in for an article of the page's own
            texts.append(slot_text(page, here, set(constant or [])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Main text of every page (page_id, url, html): page_id, url, text, n_chars."""
    scratch = Scratch(pages.sparkSession, "templates")
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").withColumn("host", host_of("url"))
    keyed = pages.withColumn("page", F.xxhash64("page_id", "url", F.crc32(F.coalesce("html", F.lit("")))))
    found = deduce_templates(keyed, scratch)
    with_template = pages.join(found, "host", "left").select("page_id", "url", "html", "roots", "constant")
    return with_template.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")
